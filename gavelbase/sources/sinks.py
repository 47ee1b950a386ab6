"""Writing results: conforming CSV, partitioned tables, reports, checkpoints of runs."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.functions.clean import legal


def sanitized(df: DataFrame) -> DataFrame:
    """Without characters that workbooks refuse, in all string columns."""
    return df.select(*(legal(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes))


def write_table(df: DataFrame, path: str, partition: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet, partitioned; the committed job replaces or extends the table as a whole."""
    w = df.write.mode(mode)
    (w.partitionBy(*partition) if partition else w).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", mark: bool = False) -> None:
    """CSV with a header; ``mark`` begins each file with a byte order mark, as spreadsheet programs want it."""
    clean = sanitized(df)
    if mark and clean.columns:
        clean = clean.withColumnRenamed(clean.columns[0], "\ufeff" + clean.columns[0])
    clean.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def write_or_aside(df: DataFrame, path: str, attempts: int = 3) -> str:
    """Write a table and return where: at ``path``, or, where that fails again and again, beside it under the time, so that no run's result is lost."""
    for k in range(attempts):
        try:
            write_table(df, path)
            return path
        except Exception:
            if k + 1 == attempts:
                aside = f"{path}_{datetime.now(timezone.utc).strftime('%Y%m%d_%H%M%S')}"
                write_table(df, aside)
                return aside
    return path


def save_then_raise(df: DataFrame, path: str, work) -> None:
    """Do the work; if it fails, save what there is under the time first, then let the error go on."""
    try:
        work()
    except Exception:
        write_table(df, f"{path}_error_{datetime.now(timezone.utc).strftime('%Y%m%d_%H%M%S')}")
        raise


def manifest(spark: SparkSession, folder: str, parts: dict[str, str], most_parts: int = 10_000) -> dict:
    """What lies under a folder of regions: of each part (name to path) its rows; written as one document beside them."""
    if len(parts) > most_parts:
        raise ValueError(f"a manifest has at most {most_parts} parts")
    rows = [(name, path, spark.read.parquet(path).count()) for name, path in sorted(parts.items())]
    return write_report(spark.createDataFrame(rows, "region string, path string, n bigint").orderBy("region"), f"{folder}/manifest.json", most_parts)


def write_report(df: DataFrame, path: str, most_rows: int = 10_000) -> dict:
    """A small aggregate as one JSON document; a larger result is refused."""
    rows = [r.asDict(recursive=True) for r in df.limit(most_rows + 1).collect()]
    if len(rows) > most_rows:
        raise ValueError(f"a report has at most {most_rows} rows")
    report = {"updated_at": datetime.now(timezone.utc).isoformat(), "rows": rows}
    with open(path + ".tmp", "w", encoding="utf-8") as f:
        json.dump(report, f, ensure_ascii=False, default=str)
    os.replace(path + ".tmp", path)
    return report
