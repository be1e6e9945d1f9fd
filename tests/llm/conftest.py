import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import CLASHES, EDGES, documents  # noqa: E402


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, blanks, repeated rows, a very long text, clashing column names."""
    from pyspark.sql import functions as F
    rows = [(i, t, None if k % 5 == 4 else "en", None if k % 4 == 3 else "a") for k, (i, t) in enumerate(EDGES)]
    return documents(spark, rows).select("*", *[F.lit(c).alias(c) for c in CLASHES]).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(k, int(k % 3 > 0), int(k % 3 == 0)) for k in range(1, 11)] + [(None, 1, 1), (1, None, None), (2, 0, 1)],
                                 "doc_id bigint, quality int, toxic int")
