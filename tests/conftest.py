import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skyledger.session import build_session

    session = build_session(
        "tests", "local[4]", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def feed(spark):
    from skyledger.plans.feed import raw_feed

    return raw_feed(spark, SMALL)


@pytest.fixture(scope="session")
def clean(feed):
    from skyledger.plans.cleanse import cleanse

    return cleanse(feed).drop("RH").persist()
