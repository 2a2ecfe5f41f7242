"""The corpus pipeline: stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.common import table
from tillroll.llm.stages import STAGES
from tillroll.session import materialize

#: Language ID and the pattern search for personal data are fitted, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
