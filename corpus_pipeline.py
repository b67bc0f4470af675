"""From documents to encoded training data, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. Its
result is written as Parquet and read again as the next one's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placecount.llm import jaccard, mixing, pieces, secret_scan, toxicity
from placecount.llm.queries import MODEL_FILE
from placecount.llm.shipping import ship
from placecount.session import durable

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# The classifier, the hashed sample keys and the encoder have no counterpart in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not call toxic."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.score(docs, toxicity.fit(docs, labels)).where("not toxic").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked by five-word shingles at a similarity of 0.8."""
    ship(spark)
    return jaccard.keep_one(docs.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets masked. A source is an owner."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    return secret_scan.mask_live(docs, owner=F.col("source"), repo=F.col("doc_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    docs = docs.select(*COLUMNS)
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    mixed = durable(mixing.mix(durable(mixing.quality_weights(sized, labels))).select("doc_id", "repeats"))
    return mixing.repeat_documents(docs, mixed).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with a digest of the ids and of the text they decode to."""
    ship(spark)
    return pieces.encode_documents(docs, MODEL_FILE, keep=("doc_id", "lang", "source"), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
