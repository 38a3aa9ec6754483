"""The registered queries against their SQL, and the registry itself."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_oracles import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from tessera.llm.oracle import ORACLE  # noqa: E402
from tessera.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), SF, QUERIES[name], ORACLE[name]) == []


def test_registry():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x[:2] == "op" and x[2].isdigit()}
    assert "pipeline" in names and set(ORACLE) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5
