"""Models that predict a count, and from it a condition.

Both are linear in hour, weekday and a term of the place; the one of the condition also
in the count. There may be more places than a driver can hold, so their terms are never
unknowns of a solver: they are eliminated from the equations place by place (a Schur
complement), a small system for the rest is solved on the driver, and the terms follow
place by place. They stay a table, which scoring joins.

* The count: ridge regression. One aggregation gives sums for each place, a second one
  over those the reduced equations. No iteration, no switch by size.
* The condition: multinomial logistic regression by Newton's method over weighted cells,
  one row for all observations that are alike. A step adds up gradients and curvatures
  for each place inside tasks, so a place with a third of all cells arrives as one row
  from each task. Cells are laid out by ranges of places once, so other places arrive as
  one row, in two tasks at most. It ends when no step can gain anything. Intercepts carry no penalty,
  so the expected numbers of the conditions are then the observed ones, which tells
  anyone that the fit has converged.

Penalties are in units of the deviations of the inputs (and of the count), as Spark's own
estimators have them, and converged results agree with those.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placecount.functions import formats
from placecount.functions.expressions import half_up, iso_weekday, parsed_date
from placecount.operators.filters import require
from placecount.roles import DATA_COLUMNS
from placecount.session import durable

REG_PARAM = 0.1
MAX_STEPS = 50
# A step that could gain less than this, in the log likelihood of all rows, is the last.
LEAST_GAIN = 1e-6
_HELD_PLACES = 2_000
_ROWS = 2_000  # that a task turns into arrays at a time

# The wording of a prediction.
PREDICTION_FORMAT = (
    "Prediction Results:\n\n"
    "Junction: %s\n"
    "Date: %s\n"
    "Hour: %s\n\n"
    "Predicted Vehicle Count: %s\n"
    "Predicted Road Condition: %s\n"
)


def index_labels(df: DataFrame, column: str) -> StringIndexerModel:
    """Index of a text column by frequency: the most frequent label first, equals in text
    order. Unseen and null values share one extra index. The vocabulary is the model."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).collect()
    labels = [row[column] for row in sorted(counts, key=lambda row: (-row["n"], row[column]))]
    return StringIndexerModel.from_labels(
        labels, inputCol=column, outputCol=f"{column}_index", handleInvalid="keep"
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _of_place(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds ``__term``, null for a place without one. Spark sends the terms to all tasks if
    the table is small, and deals both sides by place if not."""
    keyed = terms.select(F.col("place").alias("__place"), F.col("term").alias("__term"))
    return rows.join(keyed, F.col("place") == F.col("__place"), "left").drop("__place")


@dataclass(frozen=True)
class CountModel:
    """``terms`` holds (place, term); a place that is not in it has none."""

    intercept: float
    hour: float
    dow: float
    terms: DataFrame

    def score(self, rows: DataFrame, name: str) -> DataFrame:
        value = self.intercept + self.hour * F.col("hour") + self.dow * F.col("dow")
        return _of_place(rows, self.terms).withColumn(name, value + F.coalesce("__term", F.lit(0.0))).drop("__term")

    def save(self, path: str) -> None:
        spark = self.terms.sparkSession
        self.terms.write.parquet(f"{path}/terms")
        row = [(self.intercept, self.hour, self.dow)]
        spark.createDataFrame(row, "intercept double, hour double, dow double").write.parquet(f"{path}/rest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CountModel:
        rest = spark.read.parquet(f"{path}/rest").first()
        return cls(*rest, spark.read.parquet(f"{path}/terms"))


def fit_count(obs: DataFrame, reg_param: float = REG_PARAM) -> CountModel:
    """Ridge regression of the count on hour, weekday and place, over the rows that have
    the first two and a count. Rows without a place take part, but have no term.

    With ``n_p`` of ``n`` rows, a place's term is ``s = 1 / (1 + l (1 - n_p / n))`` times
    what intercept and slopes leave of its mean, ``l`` being the penalty over the count's
    deviation. Put into the equations of the others, that takes ``s / n_p`` times the
    products of the place's sums away from them. A constant input has no slope, and the
    only place no term; a constant count is the intercept.
    """
    require(obs, "place", "hour", "dow", "v")
    x = {c: F.col(c).cast("double") for c in ("hour", "dow", "v")}
    pairs = [(a, b) for i, a in enumerate(x) for b in list(x)[i:]]
    sums = durable(
        obs.dropna(subset=["hour", "dow", "v"])
        .groupBy("place")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            *[F.sum(column).alias(c) for c, column in x.items()],
            *[F.sum(x[a] * x[b]).alias(f"{a}_{b}") for a, b in pairs],
        )
    )
    whole = sums.agg(*[F.sum(c).alias(c) for c in sums.columns if c != "place"]).first()
    n = whole["n"]
    if not n:
        raise ValueError("no complete rows to train on")
    mean = {c: whole[c] / n for c in x}
    product = {(a, b): whole[f"{a}_{b}"] - n * mean[a] * mean[b] for a, b in pairs}
    spread = math.sqrt(max(product["v", "v"], 0.0) / n)
    none = sums.select("place", F.lit(0.0).alias("term")).where("false")
    if spread <= 1e-12 * abs(mean["v"]) or not spread:
        return CountModel(mean["v"], 0.0, 0.0, none)
    penalty = reg_param / spread
    n_p = F.col("n")
    shrink = F.when(F.col("place").isNull() | (n_p == n), 0.0).otherwise(1 / (1 + penalty * (1 - n_p / n)))
    about = {"one": n_p} | {c: F.col(c) - mean[c] * n_p for c in x}  # sums of deviations
    used = [c for c in ("hour", "dow") if product[c, c] > 1e-12 * whole[f"{c}_{c}"]]
    unknown = ["one", *used]
    taken = sums.agg(
        *[F.sum(shrink / n_p * about[a] * about[b]).alias(f"{a}_{b}") for a in unknown for b in (*unknown, "v")]
    ).first()

    def entry(a: str, b: str) -> float:
        if "one" in (a, b):
            full = n if a == b else 0.0
        else:
            full = product.get((a, b), product.get((b, a))) * (1 + penalty * (a == b))
        return full - taken[f"{a}_{b}"]

    left = np.array([[entry(a, b) for b in unknown] for a in unknown])
    right = np.array([(product[a, "v"] if a != "one" else 0.0) - taken[f"{a}_v"] for a in unknown])
    solved = dict(zip(unknown, np.linalg.lstsq(left, right, rcond=None)[0].tolist()))
    slope = {c: solved.get(c, 0.0) for c in ("hour", "dow")}
    rest = about["v"] - solved["one"] * n_p - sum((slope[c] * about[c] for c in slope), F.lit(0.0))
    terms = sums.where((F.col("place").isNotNull()) & (n_p < n)).select("place", (shrink / n_p * rest).alias("term"))
    intercept = mean["v"] + solved["one"] - sum(slope[c] * mean[c] for c in slope)
    return CountModel(intercept, slope["hour"], slope["dow"], durable(terms))


@dataclass(frozen=True)
class ConditionModel:
    """``labels`` are all conditions, most frequent first. Of the first ``len(weights)`` of
    ``fitted``, ``weights`` holds intercept and slopes of hour, weekday and count;
    ``terms`` (place, term) an array of a place's terms in the same order."""

    labels: list[str]
    fitted: list[str]
    weights: list[list[float]]
    terms: DataFrame

    def margins(self, rows: DataFrame, name: str) -> DataFrame:
        inputs = [F.lit(1.0), *(F.col(c).cast("double") for c in ("hour", "dow", "v"))]

        def margin(k: int) -> Column:
            linear = sum((w * x for w, x in zip(self.weights[k], inputs)), F.lit(0.0))
            return linear + F.coalesce(F.get("__term", F.lit(k)), F.lit(0.0))

        values = F.array(*[margin(k) for k in range(len(self.fitted))])
        return _of_place(rows, self.terms).withColumn(name, values).drop("__term")

    def score(self, rows: DataFrame, name: str) -> DataFrame:
        """The condition with the largest margin; of equals the more frequent one."""
        best = F.array_position("__margins", F.array_max("__margins")).cast("int") - 1
        label = F.get(F.array(*map(F.lit, self.fitted)), best)
        return self.margins(rows, "__margins").withColumn(name, label).drop("__margins")

    def shares(self, rows: DataFrame, name: str = "shares") -> DataFrame:
        """Adds an array of the probabilities of ``fitted``."""
        scaled = F.transform("__margins", lambda m: F.exp(m - F.array_max("__margins")))
        total = F.aggregate("__scaled", F.lit(0.0), lambda a, b: a + b)
        out = self.margins(rows, "__margins").withColumn("__scaled", scaled)
        return out.withColumn(name, F.transform("__scaled", lambda e: e / total)).drop("__margins", "__scaled")

    def save(self, path: str) -> None:
        spark = self.terms.sparkSession
        self.terms.write.parquet(f"{path}/terms")
        schema = "labels array<string>, fitted array<string>, weights array<array<double>>"
        spark.createDataFrame([(self.labels, self.fitted, self.weights)], schema).write.parquet(f"{path}/rest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ConditionModel:
        rest = spark.read.parquet(f"{path}/rest").first()
        return cls(rest["labels"], rest["fitted"], rest["weights"], spark.read.parquet(f"{path}/terms"))


@dataclass(frozen=True)
class _Newton:
    """Newton's method with the terms of places eliminated.

    ``x`` are one and the inputs, scaled by ``mean`` and ``spread``; the curvature of a cell
    in the margins of two conditions is a number ``c_kl = c_lk``, so its sums over a place
    times each ``x`` are all that the place adds to the equations.
    """

    cells: DataFrame  # place, x1 .. x3, label, n
    mean: list[float]
    spread: list[float]
    classes: int
    n: float
    reg_param: float

    @property
    def inputs(self) -> int:
        return 4

    def sums_of_places(self, places: DataFrame, theta: np.ndarray) -> DataFrame:
        """(place, n_p, u, data): of each place and task, gradient and curvatures. Rows
        without a place add up loss, gradient and curvature of ``theta``."""
        k, f, mean, spread = self.classes, self.inputs, self.mean, self.spread
        above = np.triu_indices(k)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[str, list] = {}
            whole = np.zeros(1 + k * f + (k * f) ** 2)

            def flushed() -> pa.RecordBatch:
                rows = [(p, n_p, u.tolist(), data.tobytes()) for p, (n_p, u, data) in held.items()]
                held.clear()
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[i] for r in rows], t)
                        for i, t in enumerate((pa.string(), pa.float64(), pa.list_(pa.float64()), pa.binary()))
                    ],
                    names=["place", "n_p", "u", "data"],
                )

            for batch in _slices(batches):
                m = batch.num_rows
                weight = batch.column("n").to_numpy()
                inputs = [batch.column(f"x{i}").to_numpy() for i in range(1, f)]
                x = np.column_stack([np.ones(m), *((c - a) / s for c, a, s in zip(inputs, mean, spread))])
                u = batch.column("u").flatten().to_numpy().reshape(m, k)
                margins = x @ theta.T + u
                top = margins.max(axis=1, keepdims=True)
                grown = np.exp(margins - top)
                p = grown / grown.sum(axis=1, keepdims=True)
                label = batch.column("label").to_numpy()
                whole[0] += weight @ (np.log(grown.sum(axis=1)) + top[:, 0] - margins[np.arange(m), label])
                gradient = p.copy()
                gradient[np.arange(m), label] -= 1
                gradient *= weight[:, None]
                curve = weight[:, None, None] * (p[:, :, None] * np.eye(k) - p[:, :, None] * p[:, None, :])
                whole[1 : 1 + k * f] += (gradient.T @ x).ravel()
                bent = np.einsum("mkl,mf,mg->kflg", curve, x, x, optimize=True)
                whole[1 + k * f :] += bent.ravel()
                # Of each place: gradient, then the curvatures times each x.
                half = curve[:, *above]
                parts = np.concatenate([gradient, (half[:, None] * x[:, :, None]).reshape(m, -1)], axis=1)
                coded = batch.column("place").dictionary_encode()
                code = coded.indices.to_numpy()
                order = np.argsort(code, kind="stable")
                first = np.flatnonzero(np.diff(code[order], prepend=-1))
                added = np.add.reduceat(parts[order], first, axis=0)
                n_p = batch.column("n_p").to_numpy()
                for at, name, data in zip(order[first], coded.dictionary.to_pylist(), added):
                    if name in held:
                        held[name][2] += data
                    else:
                        held[name] = [float(n_p[at]), u[at].copy(), data.copy()]  # not the whole arrays
                if len(held) >= _HELD_PLACES:
                    yield flushed()
            if held:
                yield flushed()
            held[None] = [0.0, np.zeros(k), whole]
            yield flushed()

        joined = self.cells.join(places.select("place", "n_p", "u"), "place")
        return joined.mapInArrow(run, "place string, n_p double, u array<double>, data binary")

    def reduced(self, sums: DataFrame) -> DataFrame:
        """(place, n_p, u, solved, data): of each place what a step needs to find its terms,
        and of each task, without a place, its share of the reduced equations."""
        k, f, n, reg_param = self.classes, self.inputs, self.n, self.reg_param
        size = k * f
        row, column = np.triu_indices(k)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, right, left = 0.0, np.zeros(size), np.zeros((size, size))
            at: list | None = None

            def closed(place: list) -> tuple:
                nonlocal loss, right, left
                name, n_p, u, data = place
                if n_p >= n:  # the only place has no term
                    return name, n_p, u.tolist(), np.zeros((k, 1 + size)).tobytes(), None
                penalty = reg_param * n_p * (1 - n_p / n) * n / (n - 1)  # by its column's variance
                gradient = data[:k] + penalty * u
                # Rows: the place's margins; columns: those of theta, by condition and input.
                cross = np.empty((k, k, f))
                cross[row, column] = cross[column, row] = data[k:].reshape(f, -1).T
                own = cross[:, :, 0] + penalty * np.eye(k)
                cross = cross.reshape(k, size)
                solved = np.linalg.solve(own, np.column_stack([gradient, cross]))
                loss += penalty / 2 * float(u @ u)
                right = right - cross.T @ solved[:, 0]
                left = left - cross.T @ solved[:, 1:]
                return name, n_p, u.tolist(), solved.tobytes(), None

            def rows(found: list[tuple]) -> pa.RecordBatch:
                types = (pa.string(), pa.float64(), pa.list_(pa.float64()), pa.binary(), pa.list_(pa.float64()))
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in found], t) for i, t in enumerate(types)],
                    names=["place", "n_p", "u", "solved", "data"],
                )

            for batch in _slices(batches):
                found = []
                for name, n_p, u, data in zip(*(batch.column(c).to_pylist() for c in ("place", "n_p", "u", "data"))):
                    data = np.frombuffer(data)
                    if name is None:
                        loss += data[0]
                        right = right + data[1 : 1 + size]
                        left = left + data[1 + size :].reshape(size, size)
                    elif at and at[0] == name:
                        at[3] = at[3] + data
                    else:
                        if at:
                            found.append(closed(at))
                        at = [name, n_p, np.array(u), data]
                if found:
                    yield rows(found)
            last = [closed(at)] if at else []
            yield rows([*last, (None, 0.0, [], b"", [loss, *right.tolist(), *left.ravel().tolist()])])

        dealt = sums.repartition("place").sortWithinPartitions("place")
        return dealt.mapInArrow(run, "place string, n_p double, u array<double>, solved binary, data array<double>")

    def moved(self, places: DataFrame, change: np.ndarray, step: float) -> DataFrame:
        """(place, n_p, u) after a step, of the rows of ``reduced`` that are places."""
        k = self.classes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                m = batch.num_rows
                u = batch.column("u").flatten().to_numpy().reshape(m, k)
                solved = np.frombuffer(b"".join(batch.column("solved").to_pylist())).reshape(m, k, -1)
                new = u - step * (solved[:, :, 0] + solved[:, :, 1:] @ change)
                offsets = pa.array(np.arange(m + 1) * k, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("place"), batch.column("n_p"), pa.ListArray.from_arrays(offsets, pa.array(new.ravel()))],
                    names=["place", "n_p", "u"],
                )

        rows = places.where("place is not null").select("place", "n_p", "u", "solved")
        return rows.mapInArrow(run, "place string, n_p double, u array<double>")

    def solve(self, theta: np.ndarray, max_steps: int = MAX_STEPS) -> tuple[np.ndarray, DataFrame]:
        """Weights by condition and input, and (place, term)."""
        k, f = self.classes, self.inputs
        size = k * f
        zeros = F.array(*[F.lit(0.0)] * k)
        places = self.cells.groupBy("place").agg(F.sum("n").alias("n_p")).withColumn("u", zeros)
        penalty = self.reg_param * self.n * np.tile(np.arange(f) > 0, k)
        gauge = np.kron(np.ones((k, k)), np.diag([1.0, *[0.0] * (f - 1)]))  # intercepts may all shift alike
        best, kept, change, step = math.inf, None, np.zeros(size), 1.0
        for _ in range(max_steps):
            here = theta if kept is None else theta + step * change.reshape(k, f)
            found = durable(self.reduced(self.sums_of_places(places if kept is None else self.moved(kept, change, step), here)))
            parts = found.where("place is null").select(F.posexplode("data").alias("i", "value"))
            total = np.zeros(1 + size + size**2)
            for row in parts.groupBy("i").agg(F.sum("value").alias("value")).collect():
                total[row["i"]] = row["value"]
            flat = here.ravel()
            loss = total[0] + penalty @ flat**2 / 2
            if loss > best + 1e-9 * abs(best):
                step /= 2  # too far; try half the way from where the step began
                continue
            right = total[1 : 1 + size] + penalty * flat
            left = total[1 + size :].reshape(size, size) + np.diag(penalty)
            theta, best, kept, step = here, loss, found, 1.0
            change = -np.linalg.lstsq(left + gauge * max(np.trace(left) / size, 1e-12), right, rcond=None)[0]
            if -right @ change < LEAST_GAIN * 2:
                # What the terms of places could still gain is found by one more look at their share.
                break
        moved = self.moved(kept, change, 1.0)
        return theta + change.reshape(k, f), durable(moved.select("place", F.col("u").alias("term")))


def fit_condition(obs: DataFrame, reg_param: float = REG_PARAM, max_steps: int = MAX_STEPS) -> ConditionModel:
    """Multinomial logistic regression of the condition on hour, weekday, count and place,
    over the rows without any null, until it has converged.

    A condition that no complete row has is known (``labels``) but never predicted, and so
    is the extra class that an index with room for unseen values would add. The driver
    holds the conditions and equations of 4 unknowns for each.
    """
    require(obs, "place", "hour", "dow", "v", "condition")
    complete = reduce(
        Column.__and__, [F.col(c).isNotNull() for c in DATA_COLUMNS if c in obs.columns]
    )
    cell = ("place", "hour", "dow", "v", "condition")
    counted = obs.groupBy(*cell).agg(
        F.count_if(complete).cast("double").alias("n"),
        F.count(F.lit(1)).cast("double").alias("n_all"),
    )
    cells = durable(counted.repartitionByRange(*cell).sortWithinPartitions("place"))
    counts = cells.where("condition is not null").groupBy("condition").agg(F.sum("n_all"), F.sum("n")).collect()
    ordered = sorted(counts, key=lambda row: (-row[1], row[0]))
    labels, fitted = [row[0] for row in ordered], [row[0] for row in ordered if row[2]]
    if not fitted:
        raise ValueError("no complete rows to train on")
    cells = cells.where("n > 0")
    inputs = ("hour", "dow", "v")
    moments = cells.agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(c)).alias(c) for c in inputs]
    ).first()
    n = moments["n"]
    mean = {c: moments[c] / n for c in inputs}
    about = cells.agg(*[F.sum(F.col("n") * (F.col(c) - mean[c]) ** 2).alias(c) for c in inputs]).first()
    spread = {c: math.sqrt(about[c] / (n - 1)) if n > 1 and about[c] > 0 else 0.0 for c in inputs}
    values = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs, 1)]
    label = (F.array_position(F.array(*map(F.lit, fitted)), F.col("condition")) - 1).cast("long")
    newton = _Newton(
        cells.select("place", *values, label.alias("label"), "n"),
        [mean[c] for c in inputs],
        [spread[c] or 1.0 for c in inputs],
        len(fitted),
        n,
        reg_param,
    )
    shares = np.log([row[2] / n for row in ordered if row[2]])
    start = np.zeros((len(fitted), 4))
    start[:, 0] = shares - shares.mean()
    theta, terms = newton.solve(start, max_steps)
    slopes = theta[:, 1:] / np.array([spread[c] or 1.0 for c in inputs])
    intercepts = theta[:, 0] - slopes @ np.array([mean[c] for c in inputs])
    return ConditionModel(labels, fitted, np.column_stack([intercepts, slopes]).tolist(), terms)


@dataclass(frozen=True)
class Predictor:
    """Both fitted models. Retraining makes a new one; nothing is changed in place."""

    count_model: CountModel
    condition_model: ConditionModel

    def save(self, root: str, version: str) -> None:
        """Write both models aside, then one manifest that names the pair. Spark shows a
        written file only once its job is committed, so readers see whole versions, and a
        save that fails leaves the former one current."""
        spark = self.count_model.terms.sparkSession
        path = f"parts/{uuid.uuid4().hex}"
        self.count_model.save(f"{root}/{path}/count")
        self.condition_model.save(f"{root}/{path}/condition")
        named = spark.range(1).select(
            F.lit(version).alias("version"), F.lit(path).alias("path"), F.current_timestamp().alias("saved_at")
        )
        named.write.mode("append").parquet(f"{root}/manifests")

    @classmethod
    def load(cls, root: str, version: str | None = None) -> Predictor:
        """A version, saved last if it was saved several times; the current one by default."""
        spark = SparkSession.getActiveSession()
        saved = versions(spark, root)
        found = (saved if version is None else saved.where(F.col("version") == version)).orderBy(F.desc("saved_at")).first()
        if found is None:
            raise ValueError(f"no version {version!r} in {root}")
        path = f"{root}/{found['path']}"
        return cls(CountModel.load(spark, f"{path}/count"), ConditionModel.load(spark, f"{path}/condition"))

    def predict(self, requests: DataFrame) -> DataFrame:
        return predict_condition(self.count_model, self.condition_model, requests)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, path, saved_at) of all versions saved below ``root``."""
    return spark.read.schema("version string, path string, saved_at timestamp").parquet(f"{root}/manifests")


def train(obs: DataFrame) -> Predictor:
    return Predictor(fit_count(obs), fit_condition(obs))


def retrain(obs: DataFrame, root: str, version: str) -> Predictor:
    """Fit on new data and keep the result beside earlier versions."""
    predictor = train(obs)
    predictor.save(root, version)
    return predictor


def requests(
    spark: SparkSession, rows: list[tuple[str, str, int]]
) -> DataFrame:
    """(place, date, hour) requests as a frame; larger sets come from a table."""
    return spark.createDataFrame(rows, "place string, obs_date string, hour int")


def predict_count(model: CountModel, requests: DataFrame) -> DataFrame:
    """Adds ``predicted_v``, rounded half up; it may be negative. Works on any number
    of rows, batch or stream. A row without hour or date has a null prediction."""
    require(requests, "place", "obs_date", "hour")
    day = parsed_date(F.col("obs_date"), dict(requests.dtypes)["obs_date"])
    asked = requests.withColumn("dow", iso_weekday(day))
    return model.score(asked, "__value").withColumn("predicted_v", half_up(F.col("__value"))).drop("__value")


def predict_condition(
    count_model: CountModel, condition_model: ConditionModel, requests: DataFrame
) -> DataFrame:
    """Predicted count, then the condition predicted from it, in one plan. Both are null
    for a row without hour or date."""
    counted = predict_count(count_model, requests.drop("v", "condition"))
    chained = counted.withColumn("v", F.col("predicted_v").cast("double"))
    return condition_model.score(chained, "predicted_condition").drop("v")


def condition_totals(model: ConditionModel, obs: DataFrame) -> DataFrame:
    """(condition, n): how often the model expects each condition over ``obs``, rounded. Over
    the complete rows that it was fitted on this is how often each occurs, as intercepts
    carry no penalty; any other fit would miss it."""
    shares = model.shares(obs.dropna(subset=["hour", "dow", "v"]))
    expected = shares.select(F.posexplode("shares").alias("k", "share")).groupBy("k").agg(F.sum("share").alias("n"))
    label = F.get(F.array(*map(F.lit, model.fitted)), F.col("k"))
    return expected.select(label.alias("condition"), F.round("n").cast("long").alias("n"))


def prediction_text(predictions: DataFrame) -> DataFrame:
    """A text column beside the predictions."""
    return predictions.withColumn(
        "text",
        F.format_string(
            PREDICTION_FORMAT,
            "place",
            F.col("obs_date").cast("string"),
            formats.clock_hour(F.col("hour")),
            formats.no_decimals(F.col("predicted_v").cast("double")),
            "predicted_condition",
        ),
    )
