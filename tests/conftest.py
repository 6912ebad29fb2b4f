import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from leadlens.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
