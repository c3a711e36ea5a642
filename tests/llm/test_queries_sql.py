"""The package's queries next to their SQL, on the smallest tables."""

import os

import compare
import pytest

from wakeline.llm.queries import ORACLES, QUERIES

FOLDER = f"{compare.DATA}/sf{os.environ.get('LLM_SF', '0.001')}"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    verdict = compare.compare(spark, compare.database(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name])
    assert verdict == "", verdict
