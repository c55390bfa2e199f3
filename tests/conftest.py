import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tight(spark):
    """Limits so small that every operator takes its way for large data."""
    spark.conf.set("wardflow.maxGroupRows", "25")
    spark.conf.set("wardflow.maxBroadcastRows", "40")
    yield spark
    spark.conf.unset("wardflow.maxGroupRows")
    spark.conf.unset("wardflow.maxBroadcastRows")


@pytest.fixture
def readings(spark):
    """3000 rows; one key holds a third of them, sort values tie, some values are NULL."""
    from pyspark.sql import functions as F

    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 70).cast("string"))
        ).alias("key"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 7919 % 1000 as int) * 13)").alias("ts"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 31 % 101).alias("v"),
        (F.col("id") * 17 % 11).alias("score"),
    )
