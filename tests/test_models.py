import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from conftest import SF_DIR
from placecount.operators import models
from placecount.operators.normalise import normalise
from placecount.plans.tables import events
from placecount.sources import read_obs

OFFSETS = {"A": 0, "B": 5, "C": 20}


@pytest.fixture(scope="module")
def known(spark):
    """v = 10 * hour + dow + offset of the place; congested after 15 o'clock."""
    rows = [
        (p, h, d, 10 * h + d + o, "Congested" if h > 15 else "Smooth")
        for p, o in OFFSETS.items()
        for h in range(24)
        for d in range(1, 8)
    ]
    frame = spark.createDataFrame(rows, "place string, hour int, dow int, v int, condition string")
    return frame.cache()


@pytest.fixture(scope="module")
def predictor(known):
    return models.train(known)


def plain_pipeline(inputs, *last):
    return Pipeline(
        stages=[
            StringIndexer(inputCol="place", outputCol="i", handleInvalid="keep"),
            OneHotEncoder(inputCol="i", outputCol="o"),
            VectorAssembler(inputCols=[*inputs, "o"], outputCol="features"),
            *last,
        ]
    )


def test_recovers_known_coefficients(predictor):
    model = predictor.count_model
    assert model.hour == pytest.approx(9.9857, abs=1e-3)
    assert model.dow == pytest.approx(0.9986, abs=1e-3)


def test_chained_prediction(spark, predictor):
    asked = models.requests(
        spark, [("A", "2025-04-01", 9), ("A", "2025-04-01", 20), ("new", "2025-04-01", 9)]
    )
    got = {
        (r.place, r.hour): (r.predicted_v, r.predicted_condition)
        for r in predictor.predict(asked).collect()
    }
    assert got == {("A", 9): (92, "Smooth"), ("A", 20): (202, "Congested"), ("new", 9): (100, "Smooth")}
    text = models.prediction_text(predictor.predict(asked)).filter("place = 'new'").first().text
    assert text == (
        "Prediction Results:\n\nJunction: new\nDate: 2025-04-01\nHour: 9:00\n\n"
        "Predicted Vehicle Count: 100\nPredicted Road Condition: Smooth\n"
    )


def test_all_conditions_are_known(predictor):
    assert predictor.condition_model.labels == predictor.condition_model.fitted == ["Smooth", "Congested"]


def coarse_events(spark):
    """Few places and values, so that many rows fold into one cell."""
    return events(spark, SF_DIR).withColumns(
        {"place": F.expr("cast(cast(place as int) % 3 as string)"), "v": F.expr("v div 100")}
    )


def terms_of(model):
    return {r.place: np.array(r.term) for r in model.terms.collect()}


@pytest.mark.parametrize("coarse", [False, True])
def test_eliminated_terms_give_the_regression_of_the_rows(spark, coarse):
    obs = coarse_events(spark) if coarse else events(spark, SF_DIR)
    got = models.fit_count(obs)
    fitted = plain_pipeline(["hour", "dow"], LinearRegression(labelCol="v", maxIter=10, regParam=0.1)).fit(obs)
    labels, want = fitted.stages[0].labels, fitted.stages[-1]
    terms = terms_of(got)
    assert np.allclose([got.hour, got.dow, *[terms[p] for p in labels]], want.coefficients.toArray(), atol=1e-9)
    assert got.intercept == pytest.approx(want.intercept)


def plain_classifier(obs):
    label = StringIndexer(inputCol="condition", outputCol="label")
    lr = LogisticRegression(maxIter=500, tol=1e-12, regParam=0.1, family="multinomial")
    return plain_pipeline(["hour", "dow", "v"], label, lr).fit(obs)


def same_classifier(got, fitted):
    """Coefficients agree; intercepts do up to a shift that changes nothing."""
    want = fitted.stages[-1].coefficientMatrix.toArray()
    order = [fitted.stages[-2].labels.index(label) for label in got.fitted]
    weights, terms = np.array(got.weights), terms_of(got)
    assert np.allclose(weights[:, 1:], want[order, :3], atol=1e-5)
    for i, place in enumerate(fitted.stages[0].labels):
        assert np.allclose(terms[place], want[order, 3 + i], atol=1e-5)
    intercepts = fitted.stages[-1].interceptVector.toArray()[order]
    assert np.allclose(weights[:, 0] - weights[:, 0].mean(), intercepts - intercepts.mean(), atol=1e-5)


@pytest.mark.parametrize("coarse", [False, True])
def test_newton_gives_the_classifier_of_the_rows(spark, coarse):
    obs = coarse_events(spark) if coarse else events(spark, SF_DIR)
    same_classifier(models.fit_condition(obs), plain_classifier(obs))


def many_rows(spark):
    return spark.range(100_000, numPartitions=4).select(
        F.concat(F.lit("p"), (F.col("id") % 7).cast("string")).alias("place"),
        (F.col("id") % 24).cast("int").alias("hour"),
        (F.col("id") % 5 + 1).cast("int").alias("dow"),
        (F.col("id") * 31 % 10).cast("int").alias("v"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(24)) < F.col("id") % 24, "late").otherwise("early").alias("condition"),
    )


def test_classifier_over_many_rows(spark):
    obs = many_rows(spark)
    same_classifier(models.fit_condition(obs), plain_classifier(obs))


def test_fits_do_not_depend_on_partitions(spark):
    """Converged, so the order of sums is all that differs."""
    obs = events(spark, SF_DIR)
    asked = obs.select("place", "obs_date", "hour").distinct()
    one, many = (models.train(obs.repartition(n)) for n in (1, 7))
    assert np.allclose(one.condition_model.weights, many.condition_model.weights, atol=1e-9)
    got = [sorted(map(tuple, p.predict(asked).collect())) for p in (one, many)]
    assert got[0] == got[1]


def test_two_hundred_thousand_places(spark):
    """Terms of places stay a table. One place has a third of all rows."""
    n = 200_000
    rows = spark.range(3 * n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % n).cast("string"))).alias("place"),
        (F.col("id") % 24).cast("int").alias("hour"),
        (F.col("id") % 7 + 1).cast("int").alias("dow"),
        (F.col("id") % 24 * 5 + F.pmod(F.xxhash64("id"), F.lit(30))).cast("int").alias("v"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(24)) < F.col("id") % 24, "late").otherwise("early").alias("condition"),
    )
    count = models.fit_count(rows)
    assert count.hour == pytest.approx(5, abs=0.05)
    assert count.terms.count() == rows.select("place").distinct().count() > n / 2
    # The mean of what a ridge regression leaves is zero, as its intercept has no penalty.
    scored = count.score(rows, "p")
    assert scored.agg(F.avg(F.col("p") - F.col("v"))).first()[0] == pytest.approx(0, abs=1e-6)
    condition = models.fit_condition(rows)
    got = sorted(map(tuple, models.condition_totals(condition, rows).collect()))
    assert got == sorted(map(tuple, rows.groupBy("condition").count().collect()))


@pytest.mark.parametrize("field", ["place", "hour", "dow", "v", "condition"])
def test_constant_inputs(spark, known, field):
    """A constant input has no slope, the only place no term, the only condition is always it."""
    obs = known.withColumn(field, F.lit({"place": "A", "condition": "Smooth"}.get(field, 3)))
    obs = obs.withColumn(field, F.col(field).cast(dict(known.dtypes)[field]))
    predictor = models.train(obs)
    if field == "hour":
        assert predictor.count_model.hour == 0.0
    if field == "v":
        assert (predictor.count_model.intercept, predictor.count_model.hour) == (3.0, 0.0)
    if field == "place":
        assert terms_of(predictor.count_model) == {}
    totals = sorted(map(tuple, models.condition_totals(predictor.condition_model, obs).collect()))
    assert totals == sorted(map(tuple, obs.groupBy("condition").count().collect()))
    assert predictor.predict(obs.select("place", F.lit("2025-04-01").alias("obs_date"), "hour")).count() == obs.count()


def test_separable_conditions_and_single_rows(spark):
    rows = [("a", 1, 1, 5, "x"), ("b", 23, 7, 900, "y")]
    schema = "place string, hour int, dow int, v int, condition string"
    for part in (rows, rows[:1]):
        obs = spark.createDataFrame(part, schema)
        predictor = models.train(obs)
        scored = predictor.condition_model.score(obs.withColumnRenamed("condition", "actual"), "condition")
        assert all(r.condition == r.actual for r in scored.collect())


def test_nulls_do_not_stop_training(spark, known):
    holes = known.limit(4).withColumns(
        {"hour": F.lit(None).cast("int"), "condition": F.lit("Ghost")}
    )
    unplaced = known.limit(4).withColumn("place", F.lit(None).cast("string"))
    whole = known.unionByName(holes).unionByName(unplaced)
    count_model = models.fit_count(whole)
    assert set(terms_of(count_model)) == {"A", "B", "C"}
    condition_model = models.fit_condition(whole)
    # Known to the label index though no complete row has it.
    assert condition_model.labels == ["Smooth", "Congested", "Ghost"]
    assert condition_model.fitted == ["Smooth", "Congested"]
    asked = models.requests(spark, [("A", "2025-04-01", 9), ("A", "not a date", 9)])
    got = models.predict_condition(count_model, condition_model, asked).collect()
    unscored = [r for r in got if r.obs_date == "not a date"]
    assert len(got) == 2 and len(unscored) == 1
    assert (unscored[0].predicted_v, unscored[0].predicted_condition) == (None, None)


def test_nothing_to_train_on(known):
    for fit in (models.fit_count, models.fit_condition):
        with pytest.raises(ValueError, match="no complete rows"):
            fit(known.filter("false"))
        with pytest.raises(ValueError, match="missing required columns"):
            fit(known.drop("hour"))


def test_save_load_retrain(spark, known, predictor, tmp_path, rows):
    asked = models.requests(spark, [("B", "2025-04-01", 3), ("C", "2025-04-02", 22)])
    root = str(tmp_path / "models")
    predictor.save(root, "v1")
    assert rows(models.Predictor.load(root, "v1").predict(asked)) == rows(predictor.predict(asked))
    newer = models.retrain(known.withColumn("v", F.col("v") + 1000), root, "v2")
    loaded = models.Predictor.load(root, "v2")
    assert rows(loaded.predict(asked)) == rows(newer.predict(asked))
    shift = loaded.predict(asked).first().predicted_v - predictor.predict(asked).first().predicted_v
    assert shift == 1000


def test_versions_are_whole(spark, known, predictor, tmp_path, rows, monkeypatch):
    """A save that fails half-way leaves the former version current."""
    asked = models.requests(spark, [("B", "2025-04-01", 3)])
    root = str(tmp_path / "models")
    predictor.save(root, "v1")

    def failing(self, path):
        raise OSError("disk full")

    monkeypatch.setattr(models.ConditionModel, "save", failing)
    with pytest.raises(OSError):
        models.retrain(known.withColumn("v", F.col("v") + 1000), root, "v2")
    monkeypatch.undo()
    assert [r.version for r in models.versions(spark, root).collect()] == ["v1"]
    assert rows(models.Predictor.load(root).predict(asked)) == rows(predictor.predict(asked))
    with pytest.raises(ValueError, match="no version 'v2'"):
        models.Predictor.load(root, "v2")
    newer = models.retrain(known.withColumn("v", F.col("v") + 1000), root, "v1")  # again, under the same name
    assert rows(models.Predictor.load(root, "v1").predict(asked)) == rows(newer.predict(asked))
    assert models.versions(spark, root).count() == 2


def test_clashing_columns_of_requests(spark, predictor):
    asked = models.requests(spark, [("A", "2025-04-01", 9)])
    extra = {c: F.lit("kept") for c in ("term", "u", "features", "prediction", "label")}
    got = predictor.predict(asked.withColumns(extra)).first().asDict()
    assert all(got[c] == "kept" for c in extra) and got["predicted_v"] == 92


def test_training_on_files(spark, small_csv):
    obs = normalise(read_obs(spark, small_csv))
    predictor = models.train(obs)
    # Labels of all thirteen rows, most frequent first.
    assert predictor.condition_model.labels == ["Smooth", "Congested", "Damaged"]
    # The complete rows only: those without weather or place are left out.
    assert set(terms_of(predictor.condition_model)) == {"A", "C", "B", "D", "E"}


def test_place_index(spark, known):
    model = models.index_labels(known.unionByName(known.filter("place = 'C'")), "place")
    assert model.labels == ["C", "A", "B"]


def test_a_place_gives_one_row_a_step(spark, monkeypatch):
    rows = [(str(p), (7 * p + c) % 24, c % 7 + 1, c, "ab"[(p * c) % 3 == 0]) for c in range(30) for p in range(200)]
    frame = spark.createDataFrame(rows, "place string, hour int, dow int, v int, condition string")
    monkeypatch.setattr(models, "_HELD_PLACES", 10)
    made, whole = [], models._Newton.sums_of_places

    def counted(self, places, theta):
        sums = whole(self, places, theta)
        made.append(sums.where("place is not null").count())
        return sums

    monkeypatch.setattr(models._Newton, "sums_of_places", counted)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "100")
    try:
        models.fit_condition(frame)
    finally:
        spark.conf.set(limit, before)
    # A place may be cut where a task or a batch ends.
    assert made and max(made) <= 200 + len(rows) // 100 + 20


def test_sums_hold_only_their_places(monkeypatch):
    """Each batch brings 500 known places and a new one, whose sums must not keep the
    arrays of the whole batch."""

    class Rows:
        def __getattr__(self, name):
            return lambda *_: self

        def mapInArrow(self, run, schema):
            return run

    rows = 2_000
    newton = models._Newton.__new__(models._Newton)
    for name, value in {"cells": Rows(), "mean": [0.0] * 3, "spread": [1.0] * 3, "classes": 5, "n": 1e6, "reg_param": 0.1}.items():
        object.__setattr__(newton, name, value)
    run = newton.sums_of_places(Rows(), np.zeros((5, 4)))

    def batches():
        for i in range(100):
            place = pa.array([f"p{j % 500}" for j in range(rows - 1)] + [f"new{i}"])
            x = pa.array(np.arange(rows) % 7.0)
            u = pa.array([[0.0] * 5] * rows)
            label = pa.array(np.arange(rows) % 5)
            columns = {"place": place, "x1": x, "x2": x, "x3": x, "label": label, "n": pa.array(np.ones(rows)), "n_p": x, "u": u}
            yield pa.RecordBatch.from_pydict(columns)

    tracemalloc.start()
    try:
        given = list(run(batches()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(b.num_rows for b in given) == 601
    assert peak < 30e6
