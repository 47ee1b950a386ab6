"""A pipeline of named stages: each builds a table from those before it and is written once; a finished stage is not run again."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


@dataclass
class Pipeline:
    """Stages in order, under one folder. A failing stage ends the run; the next run goes on with it."""

    spark: SparkSession
    folder: str
    stages: list[tuple[str, Callable[[Pipeline], DataFrame]]] = field(default_factory=list)

    def stage(self, name: str):
        def add(build: Callable[[Pipeline], DataFrame]):
            self.stages.append((name, build))
            return build

        return add

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def finished(self, name: str) -> bool:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name) + "/_SUCCESS")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def run(self, until: str | None = None, again: tuple[str, ...] = (), dry: bool = False) -> list[dict]:
        """Run what isn't finished, or is named in ``again``; the report has a row for each stage."""
        report, stale = [], False
        for name, build in self.stages:
            stale = stale or name in again or not self.finished(name)  # what follows a new table is built anew
            row = {"stage": name, "ran": stale and not dry, "seconds": 0.0}
            if row["ran"]:
                began = time.time()
                build(self).write.mode("overwrite").parquet(self.path(name))
                row["seconds"] = round(time.time() - began, 3)
            log.info("stage %s: %s", name, row)
            report.append(row)
            if name == until:
                break
        return report
