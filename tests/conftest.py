import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tabula.session import build_session, shared_dir

    s = build_session("local[*]", shuffle_partitions=8, app_name="tabula-tests")
    s.sparkContext.setLogLevel("OFF")
    shared_dir(s)  # a fresh local folder, since the test session names none
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]


def one_col(spark, values, name="v", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
