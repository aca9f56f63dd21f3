import os

import pytest

from veilframe.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def name_words(spark):
    """The seed dictionary: given, surname, ambiguous, stop."""
    rows = [
        ("Anna", True, False, False, False),
        ("Maria", True, False, False, False),
        ("Anne", True, False, False, False),
        ("Sophie", True, False, False, False),
        ("Schmidt", False, True, False, False),
        ("Royer", False, True, False, False),
        ("Pasquot", False, True, False, False),
        ("Peter", True, True, False, False),
        ("Haus", False, True, True, True),
        ("Plan", False, True, True, False),
        ("Rose", True, False, True, False),
        ("Berg", False, True, False, True),
        ("Der", False, False, False, True),
        ("Jo", True, False, False, False),
        ("Li", False, True, False, False),
    ]
    columns = "word string, is_given boolean, is_surname boolean, is_ambiguous boolean, is_stop boolean"
    return spark.createDataFrame(rows, columns)
