import csv
import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from palimpsest.operators.warehouse import Warehouse  # noqa: E402
from palimpsest.spec import REGISTRY  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def licence(key="LX-17", **changes):
    row = dict.fromkeys(REGISTRY.contract, "")
    row.update(
        license_nbr=key,
        business_name="Harbour Kites",
        address_building="4b",
        address_street="Quay Row",
        address_city="Port Ellis",
        address_state="QC",
        address_zip="H2X",
        license_status="granted",
        license_category="Toys",
        license_creation_date="2011-05-09T08:30:00",
    )
    row.update(changes)
    return row


@pytest.fixture
def write_csv(tmp_path):
    def write(name, rows, columns=None):
        path = tmp_path / name
        with open(path, "w", newline="", encoding="utf-8") as f:
            writer = csv.DictWriter(f, fieldnames=columns or list(rows[0]))
            writer.writeheader()
            writer.writerows(rows)
        return str(path)

    return write


DAY = date(2099, 1, 1)
