"""Shared helpers of the training-data operators: scratch tables and word counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import shared_folder

#: ASCII white space as the contracts fix it: a word is a maximal run of anything else.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


#: Rows and bytes of one Arrow batch, where the session leaves them at Spark's defaults: whole texts are
#: long, and a batch stands several times in memory, in the executor and in its Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    for name, ours in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{name}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", ours)


class Scratch:
    """Tables written as Parquet to the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``; where that is unset and
    the master is local (tests) a temporary folder is set for the session, on a
    cluster that is an error. A written table cuts the lineage, so a lost
    executor never repeats the work before it.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        small_batches(spark)
        self.base = f"{shared_folder(spark)}/aeroquarry/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the stored table."""
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as a long; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANK_RUN))).cast("long")


def unit_hash(*cols: Column) -> Column:
    """A reproducible number in (0, 1), uniform over hashed values: the top 53 bits, plus a half."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


#: Repeats of a row that one array lists; more are listed by several tasks.
REPEATS = 1000


def numbered(rows: DataFrame, count: Column) -> DataFrame:
    """Each row ``count`` times (at least once), numbered by ``nth`` from 0; of many repeats any task can take a part."""
    rows = rows.withColumn("__count", count.cast("long"))
    few = rows.where(F.col("__count") <= REPEATS).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__count") - 1)))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__count") - 1) / REPEATS).cast("long"))
    many = rows.where(F.col("__count") > REPEATS).withColumn("__part", F.explode(parts)).repartition("__part")
    last = F.least(F.col("__count"), (F.col("__part") + 1) * REPEATS) - 1
    many = many.withColumn("nth", F.explode(F.sequence(F.col("__part") * REPEATS, last))).drop("__part")
    return few.unionByName(many).drop("__count")
