"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

Toxic documents go, later copies of three consecutive lines go, one document of
every group of near duplicates stays, sources are mixed to their weights, and
what is left is encoded into vocabulary pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import linewindows, mixing, pieces, simhash, toxicity
from skyledger.llm.common import area, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), area(spark))
    return toxicity.score(docs, model).where(F.col("score") < toxicity.REJECT).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of three consecutive lines."""
    return linewindows.without_repeated_lines(docs, area(spark))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that SimHash links, under the settings of that operator."""
    return simhash.one_of_each_group(docs, area(spark))


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out as the mix of sources asks."""
    return mixing.mixed(docs, area(spark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the pieces, their number, and the text they decode to."""
    return pieces.encode(docs, pieces.Vocabulary.from_file())


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_copies),
    ("mixing", mixed_to_weights),
    ("pieces", encoded),
]

#: The model, the fingerprints and the encoding are beyond SQL; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what every stage returns is written and read by the next."""
    staged = area(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
