import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from trendspark.session import build_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", app="trendspark-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true"})
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
