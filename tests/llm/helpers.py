import os
import sys
from functools import partial

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture
def stored(spark):
    from strata.llm.queries import store

    return partial(store, spark)


def docs_frame(spark, rows, extra=False):
    """``(doc_id, text)`` rows as documents; ``extra`` adds columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        df = df.selectExpr("doc_id", "text", "'s' as source", "1 as n", "2 as node", "'x' as oid", "3 as tie", "4 as seed", "5 as found", "6 as size", "7 as kept", "8 as held_out", "9 as y", "10 as row")
    return df


def out(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
