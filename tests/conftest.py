import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tessera.session import checkpoint_root, get_session  # noqa: E402

SF = "/root/testdata/sf0.01"
SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[*]", shuffle_partitions=8)
    checkpoint_root(s)
    yield s
