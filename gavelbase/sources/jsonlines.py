"""Append logs of JSON lines: tolerant reading, the latest row per id, appending and overwriting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_lines(lines: DataFrame, fields: list[str], col: str = "value") -> DataFrame:
    """The named fields of each line that holds a JSON object, as text; blank, malformed and other lines are passed over."""
    got = lines.withColumn("_m", F.from_json(F.col(col), "map<string,string>")).where("_m is not null")
    keep = [c for c in lines.columns if c != col]
    return got.select(*keep, *(F.element_at("_m", F.lit(f)).alias(f) for f in fields))


def read_lines(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Fields of each object, with its file and ``_at``, which orders an append log: the file's time and name, where the split lies in it, and the place in the split."""
    meta = F.col("_metadata")
    # rows of a split keep their order; the number within a partition grows with it
    at = F.struct(meta["file_modification_time"].alias("written"), meta["file_path"].alias("file"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("line"))
    return parse_lines(spark.read.text(path).select("value", meta["file_path"].alias("_file"), at.alias("_at")), fields)


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key that isn't blank."""
    ok = rows.where(F.trim(F.col(f"`{key}`")) != "")
    return ok.groupBy(F.col(f"`{key}`").alias("_k")).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in rows.columns)), F.struct(*order)).alias("_r")).select("_r.*")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON state document; a missing or corrupt one is an empty table."""
    try:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    except Exception:
        return spark.createDataFrame([], schema)
