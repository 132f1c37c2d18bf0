"""Relations given by one SQL text that both engines read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from canopy.plans import bindings as b


def relation(spark: SparkSession, sf_dir: str, sql: str, read=b.table) -> DataFrame:
    """Runs SQL that names tables as {table}."""
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{n: read(spark, sf_dir, n) for n in names})


def plain(sql: str) -> str:
    """The same text for an engine where the tables are views."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)
