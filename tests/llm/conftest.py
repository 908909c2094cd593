import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

DOC = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (id, text) as documents with columns that clash with inner names."""
    def make(rows, parts=3):
        from pyspark.sql import functions as F
        df = spark.createDataFrame(rows, DOC)
        for c in ("n", "shard", "score", "_id", "_t", "kind", "runs"):
            df = df.withColumn(c, F.lit("x"))
        return df.repartition(parts)
    return make
