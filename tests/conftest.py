import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallywise.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8",
                            spark__driver__memory="12g",
                            spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


def transactions(spark, rows):
    """Rows of (user, amount, date, hour, city, province, card, device)."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(
        rows, "user_id long, amount double, d string, hour_of_day int, city string, "
              "province string, card_type string, device_type string")
    date = F.to_date("d")
    return df.select("*", date.alias("transaction_date"), (F.dayofweek(date) == 6).alias("is_weekend"),
                     F.dayofmonth(date).alias("day_of_month"),
                     F.format_string("%02d:15:30", "hour_of_day").alias("transaction_time")).drop("d")
