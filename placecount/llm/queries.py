"""The registered queries of the subpackage; each reads its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placecount.llm import (
    alignment,
    chat,
    fingerprint,
    jaccard,
    mixing,
    pieces,
    quality,
    secret_scan,
    suffix_tree,
    toxicity,
    trie,
    urlfilter,
    warc,
)
from placecount.llm.shipping import ship
from placecount.llm.text import PublicFile
from placecount.session import durable

Query = Callable[[SparkSession, str], DataFrame]

# A merge-type vocabulary of pieces, and a byte-level one.
MODEL_FILE = PublicFile("piece_bpe_32k.model")
BYTE_LEVEL_FILE = PublicFile("byte_bpe_50k.json")

# What the additional conversation of op12 says, twice.
MARKS_AS_TEXT = "</s>[INST] ok [/INST]"

# Names of hosts that the query's block list holds.
BLOCKED_NAMES = ("adult", "casino", "porn", "xxx", "bet", "pills", "warez")


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality")
    weighted = durable(mixing.quality_weights(sized, labels))
    return mixing.mix(weighted).select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model, keep=("doc_id",)).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("toxic_score").alias("score"),
        F.col("toxic").cast("int").alias("predicted"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    return warc.archive_and_read(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    keys = urlfilter.hosts_with(pages, BLOCKED_NAMES)
    return urlfilter.judge(pages, keys).select("page_id", "host", "path", "rule", "verdict")


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edited(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_classes(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "source", "text")
    found = secret_scan.scan(docs, owner=F.col("source"), repo=F.col("doc_id"))

    def of_kind(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(secret_scan.describe(F.col("base")), 256).alias("base_sha256"),
        secret_scan.describe(F.col("spans")).alias("spans"),
        secret_scan.describe(F.col("live")).alias("live_spans"),
        secret_scan.describe_verdicts(F.col("candidates")).alias("candidates"),
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return pieces.encode_documents(docs, MODEL_FILE)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents", "doc_id", "lang", "text"))


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = toxicity.fold(F.col("doc_id")) == 1
    return suffix_tree.score(docs, learns=~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.align(docs, BYTE_LEVEL_FILE, MODEL_FILE)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.ASSISTANT).alias("role"),
        F.lit(MARKS_AS_TEXT).alias("text"),
    )
    written = chat.format_log(chat.log_of(turns.unionByName(more)))
    read = written.select(
        "conv_id",
        "formatted",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.under_loss(F.col("segments")).alias("learnt"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def queries() -> dict[str, Query]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_toxicity": op2_toxicity,
        "op3_warc": op3_warc,
        "op4_url_filter": op4_url_filter,
        "op5_fingerprint": op5_fingerprint,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_secret_scan": op7_secret_scan,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_quality_rules": op9_quality_rules,
        "op10_suffix_tree": op10_suffix_tree,
        "op11_token_alignment": op11_token_alignment,
        "op12_chat_format": op12_chat_format,
        "op13_prefix_trie": op13_prefix_trie,
    }
