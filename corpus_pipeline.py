"""A corpus pipeline of the operators in ``stratalake.llm``.

Each stage takes the rows that its predecessor kept and returns the columns of ``documents``, but
for the last, which returns what a tokenizer run stores: the id, the number of tokens and the
digests of ids and text. ``run`` writes each stage as Parquet below the shared folder and reads
it back, so that a lost executor costs one stage at most.

Rows: null text or text without letters goes in the first stage. Of each group of near
duplicates the row with the smallest id stays, of equal rows one. The mix repeats or drops whole documents. Empty
tables stay empty; columns beside the five are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.bpe import encode_digests
from stratalake.llm.jaccard_join import without_near_duplicates
from stratalake.llm.language_id import UNDETERMINED, fit, held_out, predict
from stratalake.llm.mixing import mixed
from stratalake.llm.personal_data import redact
from stratalake.sources.scratch import stored


def _columns(docs: DataFrame, prefix: str = "") -> list:
    return [F.col(f"{prefix}`{c}`") for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language that was learned."""
    filters = fit(docs.filter(~held_out()))
    row = docs.select("text", F.struct(*_columns(docs)).alias("row"))
    judged = predict(row, filters, "row")
    return judged.filter(F.col("lang_pred") != UNDETERMINED).select("row.*")


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, and every document without shingles."""
    return without_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents until each source has its share of the words."""
    dealt = mixed(docs, tuple(docs.columns))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return dealt.filter("copies > 0").select(*_columns(docs), copies).drop("copy")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_digests(docs)


STAGES = [
    ("language id", language),
    ("n-gram Jaccard join", near_duplicate),
    ("personal data", personal_data),
    ("mixing sources", mixture),
    ("byte-pair encoding", tokens),
]

#: None: no stage but the first could be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
