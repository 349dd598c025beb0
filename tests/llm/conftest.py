import pandas as pd
import pytest

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    return lambda name: pd.read_parquet(f"{TABLES}/{name}.parquet")


def odd_documents(spark, texts, **more):
    """Documents with the given texts, ids from 0 (a null and a repeated id among them)."""
    rows = [(k, t) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string")
