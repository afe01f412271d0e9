import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

LOG_DDL = ("ts timestamp, uid string, log_path string, id_orig_h string, id_resp_h string, "
           "id_resp_p int, orig_bytes bigint, query string, answers array<string>, host string")
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("tidewatch-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def log_rows(spark, rows):
    """Wide log rows from dicts (missing keys are null)."""
    cols = [c.split()[0] for c in LOG_DDL.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], LOG_DDL)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)
