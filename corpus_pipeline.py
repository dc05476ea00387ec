"""From raw documents to tokens in five stages, each one of the operators in ``inundation.llm``.

A stage takes (spark, docs, sf_dir) and returns its rows, which are written as Parquet and read again as the next one's ``docs``.  All
but the last return the columns of ``documents``.  Texts may be null or empty, ids may be null or repeat and further columns are
dropped; see each operator for what it does then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inundation.llm import pieces, poisson_mix, pu_quality, secret_ledger, simhash
from inundation.llm.shared import keep, new_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The vocabulary, which only the driver reads.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the positive-unlabelled classifier scores below its threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    features = keep(pu_quality.text_features(docs), "quality")
    scored = pu_quality.score_rows(docs.select(*COLUMNS), pu_quality.fit_quality(features, labels), score_col="quality_score")
    return scored.where(F.col("quality_score") >= pu_quality.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    groups = keep(simhash.near_duplicates(docs), "groups")
    return simhash.keep_first(docs.select(*COLUMNS), groups)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets in the texts; ``n_chars`` follows where a text has changed."""
    rows = docs.select(*COLUMNS)
    ledger = secret_ledger.update_in_steps(rows, new_folder(spark, "ledger"), "doc_id")
    found = secret_ledger.findings_by_path(rows, ledger)
    some = F.size("findings") > 0
    clean = found.withColumn("clean", F.when(some, secret_ledger.redact(F.col("text"), F.col("findings"))).otherwise(F.col("text")))
    n_chars = F.when(some, F.length("clean").cast("long")).otherwise(F.col("n_chars"))
    return clean.select("doc_id", F.col("clean").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the target weights of their sources and shuffles the copies."""
    return poisson_mix.poisson_mix(docs.select(*COLUMNS)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts."""
    return pieces.encode(docs.select(*COLUMNS), pieces.read_vocabulary(PIECE_MODEL))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing to target weights", mix),
    ("SentencePiece encoding", tokens),
]

#: The classifier's fit and the piece search are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what lies between two of them is kept in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = keep(docs, f"stage-{i + 1}")
    return docs
