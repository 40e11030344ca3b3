import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from claimrisk.schemas import RAW_SCHEMA  # noqa: E402
from claimrisk.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def raw(spark):
    """Build raw billing rows from partial dictionaries; unnamed columns get usual values."""
    usual = {
        "Rndrng_NPI": 1, "Rndrng_Prvdr_Type": "Cardiology", "Rndrng_Prvdr_State_Abrvtn": "CA",
        "Rndrng_Prvdr_City": "A", "Rndrng_Prvdr_Zip5": "01234", "Rndrng_Prvdr_Ent_Cd": "I",
        "HCPCS_Cd": "99213", "HCPCS_Desc": "visit", "Place_Of_Srvc": "O", "Tot_Benes": 10,
        "Tot_Srvcs": 20.0, "Tot_Bene_Day_Srvcs": 15, "Avg_Sbmtd_Chrg": 100.0,
        "Avg_Mdcr_Alowd_Amt": 60.0, "Avg_Mdcr_Pymt_Amt": 50.0, "Avg_Mdcr_Stdzd_Amt": 55.0,
    }

    def build(*rows):
        filled = [tuple({**usual, **row}.get(c) for c in RAW_SCHEMA.fieldNames()) for row in rows]
        return spark.createDataFrame(filled, RAW_SCHEMA)

    return build
