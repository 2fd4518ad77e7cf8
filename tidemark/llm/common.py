"""Small helpers that the corpus operators share."""

from __future__ import annotations

import gc
import time
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.storage import Files, shared_folder

#: Seconds that Spark's listeners get to let go of a finished query.
SETTLE = 0.4

#: A word: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables that ``checkpointed`` has written, in order.
_written: list[str] = []


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as Parquet in the shared folder, under the application's id.

    Spark deletes the shuffle files of a finished step once nothing in the driver
    refers to them; on small disks that mustn't wait for memory to run short, so
    garbage is collected here, in Python and in the JVM, and once more when
    Spark's listeners have had time to let go of the finished query.
    """
    spark, schema = df.sparkSession, df.schema
    sc = spark.sparkContext
    path = f"{shared_folder(spark)}/tidemark-{sc.applicationId}/{uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    del df
    for pause in (SETTLE, 0):
        gc.collect()
        sc._jvm.System.gc()
        time.sleep(pause)
    return spark.read.schema(schema).parquet(path)


def written() -> int:
    """A mark in the list of written tables, for ``released``."""
    return len(_written)


def released(spark: SparkSession, since: int, but: int = 0) -> None:
    """Delete the tables written since a mark, but for the last ones; nothing may still read them."""
    end = len(_written) - but
    for path in _written[since:end]:
        Files(spark).drop(path)
    del _written[since:end]


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(column: Column) -> Column:
    """An id as text for seeded hashing; null becomes the empty string."""
    return F.coalesce(column.cast("string"), F.lit(""))
