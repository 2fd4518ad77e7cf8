"""Choice of a host and of what to do after an error, as pure expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def picked_hosts(hosts: DataFrame, group: str, state: str, zone: str, index: str) -> DataFrame:
    """The best host of each group: by state, then zone, then place in the list."""
    best = Window.partitionBy(group).orderBy(state, zone, index)
    return hosts.withColumn("__k", F.row_number().over(best)).filter("__k = 1").drop("__k")
