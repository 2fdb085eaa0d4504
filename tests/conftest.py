import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mktpanel.session import build_session

    spark = build_session("local[4]", app="mktpanel-tests", shuffle_partitions=4)
    # Tests set their own shared folder; a cluster names one in spark.checkpoint.dir.
    if not spark.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="mktpanel-tests-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    yield spark
    spark.stop()


def rows(df, *cols):
    """Collect as sorted tuples of the given (or all) columns."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
