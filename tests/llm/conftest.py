import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import ROWS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with names that operators use inside."""
    from pyspark.sql import functions as F

    base = spark.createDataFrame(ROWS, SCHEMA)
    for c in ("id", "key", "fp", "stats", "spans", "gone", "length", "rule", "kept", "n", "t"):
        base = base.withColumn(c, F.lit(f"own {c}"))
    return base.repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
