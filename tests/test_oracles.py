"""The driver's correctness gate, locally: every registered query against its DuckDB SQL at sf0.01."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracles import compare, duck  # noqa: E402

from tests.conftest import SF  # noqa: E402
from tessera.catalog import QUERIES  # noqa: E402
from tessera.oracle import ORACLE  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLE[name]) == []
