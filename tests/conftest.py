import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from txnrisk.session import build_session

    session = build_session(
        "tests", "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def txn(spark, sf):
    """Small clean transactions, stored once so that tests do not repeat the joins."""
    from txnrisk.session import stage
    from txnrisk.sources import tables as T

    return stage(T.transactions(spark, sf), "txn")


@pytest.fixture(scope="session")
def cuts(txn):
    from txnrisk.operators import split as SP

    return SP.find_cuts(txn)


@pytest.fixture(scope="session")
def parts(txn, cuts):
    return {s: txn.where(cuts.condition(s)) for s in ("train", "validation", "test")}
