import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from litreflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    s = build_session("local[*]", app="litreflow-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="litreflow-wh-"),
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="litreflow-ckpt-")})
    yield s
    s.stop()


def ts(s):
    """'2025-01-01 10:00:00' -> datetime (None passes through)."""
    import datetime as dt
    if s is None:
        return None
    return dt.datetime.fromisoformat(s)
