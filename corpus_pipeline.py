"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept,
read back from the table that was written. All but the last return the columns
of documents. Rejected documents, dropped lines, dropped copies and repeats take
effect at once. A repeated document, which the mix may take twice, is packed as
often. Nulls, empty texts and tables, and extra columns are handled as each
operator's own docstring defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm import language_ppm, line_templates, minmax_dedup, mixing, packing
from loanbook.llm.texts import documents, staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, without a likely one, or too unlike all
    labelled text, go."""
    return language_ppm.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go; ``n_chars`` follows."""
    rows = line_templates.without_templates(docs)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 80 % of five-word shingles, one row stays: that
    of the smallest id."""
    return minmax_dedup.one_of_each_group(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Token ids and link confirmation are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
