"""The stages of the corpus pipeline, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, language, mixing, personal, simhash
from tillroll.llm.common import table
from tillroll.llm.registry import sized


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop the documents in no language that the labelled ones teach.

    Those without a letter go, and those whose language scores below ``language.LEAST_SCORE``, 0.25.
    """
    return language.keep_known(docs, language.fit_not_held_out(docs))


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest id."""
    return simhash.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop the documents that the benchmark contaminates."""
    return decontaminate.remove_documents(docs, table(spark, folder, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows the text where it changes."""
    return personal.redact(docs, length="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix takes words of, each with the words it takes.

    ``text`` holds ``taken`` words, repeats included, so the words of a source come near its target;
    ``n_chars`` follows where the text changes.  ``size`` is the words the document had.
    """
    rows = sized(docs)
    quotas = mixing.shard_quotas(rows.select("source", "digest", "size"))
    dealt = mixing.mix(rows, quotas, ["doc_id", "size"], text="text", length="n_chars")
    return dealt.filter(F.col("taken") > 0).drop("digest")


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", without_copies),
    ("benchmark decontamination", decontaminated),
    ("personal data", without_personal_data),
    ("source mix", mixed),
]
