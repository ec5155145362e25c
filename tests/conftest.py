from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ticketmill import session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def make_session():
    spark = (
        session.builder("ticketmill-tests").master("local[8]")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    yield make_session()


@pytest.fixture(scope="session")
def bed(spark):
    from ticketmill.samples import bed

    return bed(spark, SF_DIR)
