import datetime

import pytest

from tabweave.session import local_session
from tests import sample

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tabweave-tests")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def run_ts():
    return datetime.datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture
def sheet_path(tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(sample.SHEET)
    return str(path)


@pytest.fixture(scope="session")
def entities(spark):
    return spark.createDataFrame(sample.terms(), sample.ENTITY_SCHEMA)
