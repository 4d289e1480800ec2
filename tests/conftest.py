import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_spark, shared_root
    s = get_spark("local[8]", 8)
    shared_root(s)  # tests set a checkpoint dir only because none is given
    yield s


@pytest.fixture()
def workdir(spark):
    from strata.session import scratch_dir
    return scratch_dir(spark, "test")
