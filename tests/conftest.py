import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from harrow.session import local_session

    session = local_session(4, shuffle_partitions=4, memory="4g", app_name="harrow-tests")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


def rows(df, *columns):
    """All rows as sorted tuples."""
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def shuffles(spark):
    """The shuffles that have files on the driver's disk, which is that of a local session."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    names = env.blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def left_behind(spark, before, seconds=10):
    """The shuffles since ``before`` that still have files; they may go a little later."""
    end = time.monotonic() + seconds
    while (left := shuffles(spark) - before) and time.monotonic() < end:
        time.sleep(0.1)
    return left
