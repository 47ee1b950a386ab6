"""Run the region pipeline and the training-data operators: python run_pipeline.py SF_DIR OUT_DIR [stage]; finished stages are not run again."""

import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from gavelbase.plans import geo_units_packed, region
from gavelbase.plans.pipeline import Pipeline
from gavelbase.session import local_session, table

try:
    from gavelbase.llm import queries as llm
    from gavelbase.llm.mixing import mix
except ModuleNotFoundError as missing:
    if missing.name != "gavelbase.llm":  # only the subpackage itself may be away
        raise
    llm = None

#: Training-data stages over the landed tables: stage to query; those of the subpackage only where it is there.
OPERATORS = {"stations": geo_units_packed.p2_found, "quantities": geo_units_packed.p4_found, "unpacked": geo_units_packed.p5_found}
if llm:
    OPERATORS |= {"records": llm.p1_records, "units_matched": llm.p3_matches, "places_linked": llm.p6_found, "paragraphs": llm.p7_paragraphs, "leaks": llm.p8_found, "look_alikes": llm.p10_found}
#: Stages over the operators' tables.
AFTER = ("documents_kept", "mix", "shares") if llm else ()


def kept(documents: DataFrame, leaks: DataFrame, look_alikes: DataFrame) -> DataFrame:
    """Documents that leak no test item, and of those that look alike the one of the smallest id."""
    clean = documents.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti")
    pairs = look_alikes.join(leaks.selectExpr("doc_id as doc_id_a").distinct(), "doc_id_a", "left_anti")
    return clean.join(pairs.selectExpr("doc_id_b as doc_id").distinct(), "doc_id", "left_anti")


def build(spark: SparkSession, d: str, out: str) -> Pipeline:
    p = Pipeline(spark, out)
    region.stages(p, d)
    for name, query in OPERATORS.items():
        p.stage(name)(lambda run, query=query: query(run.spark, d))
    if not llm:
        return p
    p.stage("documents_kept")(lambda run: kept(table(spark, d, "documents"), run.table("leaks"), run.table("look_alikes")))
    for k, name in enumerate(("mix", "shares")):
        p.stage(name)(lambda run, k=k: mix(run.table("documents_kept"), table(spark, d, "mix_targets"))[k])
    return p


if __name__ == "__main__":
    session = local_session(os.environ.get("BENCH_CPUS", "8"), "pipeline")
    for row in build(session, *sys.argv[1:3]).run(*sys.argv[3:4]):
        print(json.dumps(row))
    session.stop()
