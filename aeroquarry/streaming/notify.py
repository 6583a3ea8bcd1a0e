"""Push ingest: notifications land as JSON lines (topic, payload) and are read as a file stream."""

from __future__ import annotations

import os
import shutil
import urllib.request
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import decoders
from ..sources.lake import Lake

LANDING = "topic string, payload string"
MESSAGE = "links array<struct<rel:string,type:string,href:string>>, url string, filename string"
TIMEOUT_S, BLOCK = 15, 8192


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def parsed(messages: DataFrame, topic: str = "") -> DataFrame:
    """Adds ``ident`` (last two parts of the topic), ``file_url`` and ``file_name``; bad JSON and other topics drop out.

    The first link that is canonical or an update and holds a bulletin wins; the
    plain ``url`` and ``filename`` fields are the fallback.
    """
    body = F.from_json("payload", MESSAGE)
    fits = lambda l: l["rel"].isin("canonical", "update") & (l["type"] == "application/bufr") & (F.length(l["href"]) > 0)
    href = F.get(F.filter(F.col("_m.links"), lambda l: F.coalesce(fits(l), F.lit(False))), F.lit(0))["href"]
    parts = F.split("topic", "/")
    read = messages.where(F.col("topic").startswith(topic.removesuffix("#").rstrip("/")) & F.col("payload").rlike("^\\s*\\{")).withColumn("_m", body)
    plain = F.split(F.split(F.regexp_replace(href, "^[a-z]+://[^/]*", ""), "[?#]")[0], ";")[0]
    return read.select(
        *messages.columns,
        F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)).alias("ident"),
        F.coalesce(href, F.col("_m.url")).alias("file_url"),
        F.when(href.isNotNull(), basename(plain)).otherwise(F.col("_m.filename")).alias("file_name"),
    )


def download(url: str, name: str, folder: str) -> str:
    """Fetch to a part file, then rename; an existing file is kept, so a repeated batch does no harm. "" on failure."""
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, os.path.basename(name))
    if os.path.exists(target):
        return target
    part = f"{target}.part"
    try:
        with urllib.request.urlopen(url, timeout=TIMEOUT_S) as response, open(part, "wb") as f:
            shutil.copyfileobj(response, f, BLOCK)
        os.replace(part, target)
    except OSError:
        return ""
    return target


WANTED = "ident string, file_url string, file_name string, tries int"


def _fetched(fetch: Callable[[str, str, str], str], folder: str):
    """Downloads in tasks: each row gets the path of its file, "" where the download failed."""

    def run(frames):
        for pdf in frames:
            pdf["path"] = [fetch(u, n, os.path.join(folder, i)) for u, n, i in zip(pdf["file_url"], pdf["file_name"], pdf["ident"], strict=True)]
            yield pdf

    return run


def listen(spark: SparkSession, lake: Lake, landing: str, folder: str, checkpoint: str, topic: str = "", fetch: Callable[[str, str, str], str] = download, seconds: int | None = None, tries: int = 5, tasks: int = 8):
    """Start the stream; each micro-batch downloads its files in tasks, decodes and stores them by id.

    ``folder`` is one that all executors share. What can't be downloaded is kept in a retry table beside the
    checkpoint and tried again with the next batches, ``tries`` times in all; then it stays in the table ``failed``.
    A batch that is replayed after a crash is not stored twice: the lake remembers the stream's last batch.
    """

    def queue(number: int) -> str:
        return f"{checkpoint}/retry/{number}"

    def handle(batch: DataFrame, number: int) -> None:
        fresh = parsed(batch, topic).where("file_url IS NOT NULL AND file_name IS NOT NULL").select("ident", "file_url", "file_name", F.lit(0).alias("tries"))
        waiting = spark.read.schema(WANTED).parquet(queue(number - 1)) if number and _exists(spark, queue(number - 1)) else spark.createDataFrame([], WANTED)
        rows = fresh.unionByName(waiting).distinct().repartition(tasks, "file_url")
        got = rows.mapInPandas(_fetched(fetch, folder), WANTED + ", path string")
        done = f"{checkpoint}/fetched/{number}"
        got.write.mode("overwrite").parquet(done)  # downloads happen once; paths and failures are read from here
        got = spark.read.schema(WANTED + ", path string").parquet(done)
        lost = got.where("path = ''").select("ident", "file_url", "file_name", (F.col("tries") + 1).alias("tries"))
        lost.where(F.col("tries") < tries).write.mode("overwrite").parquet(queue(number))
        lost.where(F.col("tries") >= tries).write.mode("overwrite").parquet(f"{checkpoint}/failed/{number}")
        for (ident,) in got.where("path <> ''").select("ident").distinct().toLocalIterator():  # kinds of bulletins: a handful
            paths = [r[0] for r in got.where((F.col("ident") == ident) & (F.col("path") != "")).select("path").distinct().collect()]  # files of one batch
            try:
                decoders.ingest(lake, f"wis2/{ident}", paths, once=(f"{checkpoint}#{ident}", number))
            except LookupError:
                continue  # no decoder: the files stay for a later one
            for p in paths:
                if os.path.exists(p):
                    os.remove(p)

    stream = spark.readStream.schema(LANDING).json(landing).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).start()
    if seconds is not None:
        stream.awaitTermination(seconds)
        stream.stop()
    return stream


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
