"""The documents, from raw text to token ids: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm import byte_bpe, decontaminate, line_dedup, quality_classifier, simhash
from shoptrail.llm.common import read, stage
from shoptrail.llm.queries import QUALITY_LEAST, bpe_codec


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model, docs.columns, name="__score")
    return scored.where(F.col("__score") >= QUALITY_LEAST).drop("__score")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand elsewhere before."""
    return line_dedup.dedup_lines(docs, count=None).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose fingerprints of three-word shingles are tied by two differing bits or fewer.

    Texts without words have one fingerprint, so one of them stays.
    """
    return simhash.keep_one(docs, within=2, size=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their number and digests."""
    return byte_bpe.encode_documents(docs, bpe_codec(), ["doc_id", "lang", "source"], ids=True)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: The classifier cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
