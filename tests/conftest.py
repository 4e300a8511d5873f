import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from vigil.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(app="vigil-tests", memory="6g")


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df, *order):
    """Collected rows as tuples, sorted for comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if not order else out
