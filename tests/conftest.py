import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidelog.session import build_session

    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def log(spark):
    from tidelog.session import new_path
    from tidelog.sources.topic_log import TopicLog

    return TopicLog(spark, new_path(spark, "test"))
