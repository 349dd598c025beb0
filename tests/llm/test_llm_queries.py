"""The operators' queries against their SQL counterparts, on whole tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from check_oracles import compare, connect  # noqa: E402

from batchgate.llm.queries import ORACLES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    problem, rows, _ = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert problem is None and rows, problem
