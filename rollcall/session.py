"""SparkSession factory with the settings every module expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "rollcall", cores: str = "*", **extra: str) -> SparkSession:
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("ROLLCALL_DRIVER_MEMORY", "6g"),
    } | extra
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
