"""Registry of the queries: name, Spark callable and oracle SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(frame: DataFrame) -> DataFrame:
    """Decimals as double and whole numbers as bigint, so that both engines show the same types."""
    casts = {}
    for name, dtype in frame.dtypes:
        if dtype.startswith("decimal") or dtype == "float":
            casts[name] = "double"
        elif dtype in ("int", "smallint", "tinyint"):
            casts[name] = "bigint"
    return frame.select(*[F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`") for c in frame.columns])


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, sf: plain(build(spark, sf))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def scratch(spark: SparkSession) -> str:
    """A new folder for files a query writes: under the cluster's shared folder; only a local session may use its own disk."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared or tempfile.mkdtemp(prefix='lettrage-')}/files-{uuid.uuid4().hex}"
