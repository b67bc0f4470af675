"""Conversations rebuilt from event logs, and rendered as training texts.

A chat service logs what happens, not what was said in the end: a message opens, its
text arrives in deltas, is edited, or is generated anew. ``fold`` replays such a log.
Events are grouped by conversation and message and sorted by sequence, so that a
conversation with a third of all events is spread over tasks. All before the last
``regenerate`` of a message is gone; deltas between two edits are joined at once, so a
message of many deltas takes linear time.

``render`` writes the messages of a conversation into one text. Only here does a whole
conversation come together, as the text is one value; it arrives as one row from each
task that had messages of it. ``read_back`` parses the text again.

Everything is DataFrame functions.

Kinds of events, by (conv_id, msg):

* ``open``: a message begins; ``role`` is who speaks.
* ``delta``: ``text`` is appended.
* ``edit``: ``cut`` characters from ``at`` on are replaced by ``text``. An edit past the
  end appends; null or negative numbers are 0.
* ``regenerate``: the text so far is thrown away.

Defined results for odd logs: events of equal ``seq`` are taken by kind, then text; a
message without ``open`` has an empty role, and stands where its first event does; null
texts are empty; unknown kinds do nothing; repeated events happen twice; messages of
equal first ``seq`` stand by role, then text. A null ``conv_id`` is a conversation of
its own. An empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
DELTA_CHARS = 512
DRAFT_CHARS = 16

# The template: who speaks and what is said, between marks that no text can hold.
OPEN, CLOSE = "[INST]", "[/INST]"
LOSS_OPEN, LOSS_CLOSE = "<s>", "</s>"
SAYS = "[:]"

# A mark, or one escaped so far: a backslash after its first sign breaks it.
_PLAIN = r"([<\[])(\\*)(/?INST\]|:\]|/?s>)"
_ESCAPED = r"([<\[])\\(\\*)(/?INST\]|:\]|/?s>)"
_OPENED = r"^(?:\[INST\]|<s>)"
_CLOSED = r"\[/INST\]|</s>"


def escape(text: Column) -> Column:
    """``text`` without any mark. Marks, and what ``escape`` makes of them, get one more
    backslash each."""
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def log_of(turns: DataFrame) -> DataFrame:
    """The event log that leads to ``turns`` (conv_id, turn, role, text), as a service that
    streams would have written it: texts come in deltas; an assistant's text follows a
    draft that is thrown away; other texts come without their first word's beginning,
    which an edit puts in. Every row is a message of its own, repeated ones too."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    head = F.substring(text, 1, DRAFT_CHARS)

    def event(n: Column, kind: str, what: Column | None = None, at: int | None = None) -> Column:
        return F.struct(
            n.cast("int").alias("n"),
            F.lit(kind).alias("kind"),
            F.lit(at).cast("int").alias("at"),
            F.lit(None if at is None else 0).cast("int").alias("cut"),
            (F.lit(None).cast("string") if what is None else what).alias("text"),
        )

    def deltas(of: Column, first: int) -> Column:
        pieces = F.regexp_extract_all(of, F.lit("(?s).{1,%d}" % DELTA_CHARS), F.lit(0))
        return F.transform(pieces, lambda piece, i: event(i + first, "delta", piece))

    redone = F.concat(
        F.array(event(F.lit(1), "delta", head), event(F.lit(2), "regenerate")), deltas(text, 3)
    )
    rest = F.substring(text, DRAFT_CHARS + 1, 2**31 - 1)
    edited = F.concat(deltas(rest, 1), F.array(event(F.lit(2**31 - 1), "edit", head, 0)))
    events = F.concat(F.array(event(F.lit(0), "open")), F.when(role == ASSISTANT, redone).otherwise(edited))
    numbered = turns.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("msg"))
    return numbered.select("conv_id", "turn", role.alias("role"), "msg", F.explode(events).alias("e")).select(
        "conv_id",
        "msg",
        F.struct("turn", "e.n").alias("seq"),
        "e.kind",
        F.when(F.col("e.kind") == "open", F.col("role")).alias("role"),
        "e.at",
        "e.cut",
        "e.text",
    )


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, msg, seq, role, text) of each message of ``log`` (conv_id, msg, seq, kind,
    role, at, cut, text) after its last event. Other columns are left out."""
    events = F.array_sort(F.collect_list(F.struct("seq", "kind", "text", "role", "at", "cut")))
    grouped = log.groupBy("conv_id", "msg").agg(events.alias("events"))

    def last(kind: str) -> Column:
        return F.array_max(F.transform("events", lambda e, i: F.when(e["kind"] == kind, i).otherwise(-1)))

    live = grouped.select(
        "conv_id",
        "msg",
        F.get("events", F.lit(0))["seq"].alias("seq"),
        F.coalesce(F.get(F.filter("events", lambda e: e["kind"] == "open"), F.lit(0))["role"], F.lit("")).alias("role"),
        F.slice("events", last("regenerate") + 2, F.size("events")).alias("live"),
    )
    # Places of edits; the text before the first counts as an edit at place -1.
    edits = F.concat(
        F.array(F.lit(-1)),
        F.filter(F.transform("live", lambda e, i: F.when(e["kind"] == "edit", i)), lambda i: i.isNotNull()),
    )
    spans = F.zip_with("edits", F.concat(F.slice("edits", 2, F.size("edits")), F.array(F.size("live"))),
                       lambda edit, stop: F.struct(edit.alias("edit"), stop.alias("stop")))

    def number(value: Column) -> Column:
        return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))

    def step(text: Column, span: Column) -> Column:
        e = F.get("live", span["edit"])
        at, cut = number(e["at"]), number(e["cut"])
        changed = F.concat(
            F.substring(text, F.lit(1), at), F.coalesce(e["text"], F.lit("")), F.substr(text, at + cut + 1)
        )
        between = F.slice("live", span["edit"] + 2, span["stop"] - span["edit"] - 1)
        said = F.transform(F.filter(between, lambda x: x["kind"] == "delta"), lambda x: x["text"])
        return F.concat(F.when(span["edit"] < 0, text).otherwise(changed), F.array_join(said, ""))

    return (
        live.withColumn("edits", edits)
        .withColumn("spans", spans)
        .select("conv_id", "msg", "seq", "role", F.aggregate("spans", F.lit(""), step).alias("text"))
    )


def render(messages: DataFrame, loss_role: str = ASSISTANT) -> DataFrame:
    """(conv_id, formatted, segments) of each conversation of ``messages`` (conv_id, msg,
    seq, role, text). ``segments`` (text, loss) are the pieces of ``formatted`` in order;
    ``loss`` marks the texts of ``loss_role``, which a model is to learn to write."""
    learnt = F.col("role") == loss_role
    pieces = messages.select(
        "conv_id",
        F.struct(
            "seq",
            "role",
            "text",
            F.concat(F.when(learnt, LOSS_OPEN).otherwise(OPEN), escape(F.col("role")), F.lit(SAYS)).alias("begin"),
            escape(F.col("text")).alias("body"),
            learnt.alias("loss"),
        ).alias("m"),
    ).withColumn("m", F.col("m").withField("text", F.when(F.col("m.text") == F.col("m.body"), None).otherwise(F.col("m.text"))))
    grouped = pieces.groupBy("conv_id").agg(F.collect_list("m").alias("ms"))
    # A text without marks is its own body, so it is not shipped twice; the order is by the text itself.
    ordered = F.array_sort(
        F.transform(
            "ms",
            lambda m: F.struct(
                m["seq"], m["role"], F.coalesce(m["text"], m["body"]).alias("text"), m["begin"], m["body"], m["loss"]
            ),
        )
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def parts(m: Column) -> Column:
        end = F.when(m["loss"], LOSS_CLOSE).otherwise(CLOSE)
        return F.array(
            segment(m["begin"], F.lit(False)), segment(m["body"], m["loss"]), segment(end, F.lit(False))
        )

    segments = F.flatten(F.transform(ordered, parts))
    return grouped.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments"
    )


def format_log(log: DataFrame) -> DataFrame:
    """The rendered conversations of an event log."""
    return render(fold(log))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    turns = F.split(formatted, _CLOSED, -1)
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)  # nothing follows the last mark

    def turn(piece: Column) -> Column:
        said = F.regexp_replace(piece, _OPENED, "")
        role = F.substring_index(said, SAYS, 1)
        return F.struct(
            unescape(role).alias("role"), unescape(F.substr(said, F.length(role) + len(SAYS) + 1)).alias("text")
        )

    return F.transform(turns, turn)


def under_loss(segments: Column) -> Column:
    """What the loss mask of a conversation covers, unescaped and joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
