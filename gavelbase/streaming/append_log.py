"""An append log as a stream: the latest row of each id is kept in a table, late and repeated rows included.

Each micro-batch is reduced to its last row per id, merged with the table by a full outer join, and written beside it under the
batch's number; a small pointer file names the current version, so a batch that is run again after a lost executor gives the same version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def last_rows(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    return rows.groupBy(F.col(f"`{key}`").alias("_k")).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in rows.columns)), F.struct(*order)).alias("_r")).select("_r.*")


def _pointer(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def current_version(spark: SparkSession, path: str) -> int | None:
    fs, at = _pointer(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return int(stream.readLine())
    finally:
        stream.close()


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    version = current_version(spark, path)
    return None if version is None else spark.read.parquet(f"{path}/v={version}")


def _point(spark: SparkSession, path: str, number: int) -> None:
    """Name the current version: written beside the pointer and renamed over it in one step, so a crash leaves the old one or the new one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    _, at = _pointer(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}/_next")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf)
    fs = at.getFileSystem(conf)
    out = fs.create(beside, True)
    out.writeBytes(str(number))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(beside, at, options)


def forget(spark: SparkSession, path: str, number: int, kept: int = 2) -> None:
    """Delete versions but the last ``kept``: readers of the version before the current one may still be at work."""
    fs, at = _pointer(spark, path)
    found = sorted((int(f.getPath().getName()[2:]), f.getPath()) for f in fs.listStatus(at.getParent()) if f.getPath().getName().startswith("v="))
    for n, p in [x for x in found if x[0] <= number][:-kept]:
        fs.delete(p, True)


def upsert_log(stream: DataFrame, path: str, checkpoint: str, key: str, order: list[str]) -> StreamingQuery:
    """Start the upkeep of the table at ``path``; it ends when all that has landed is taken in."""

    def take_in(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version = current_version(spark, path)
        if version is not None and version >= number:
            return
        new = last_rows(batch, key, order)
        old = read_latest(spark, path)
        merged = new if old is None else last_rows(old.unionByName(new), key, order)
        merged.write.mode("overwrite").parquet(f"{path}/v={number}")
        _point(spark, path, number)
        forget(spark, path, number)

    return stream.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, kind: str, window: str = "1 hour", lateness: str = "2 days") -> DataFrame:
    """Rows per kind and window of event time; rows later than the watermark are left out, as streams must."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, window).alias("w"), F.col(kind).alias("kind")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "kind", "n")
