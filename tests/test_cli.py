"""Command line: exit codes and outputs of the three jobs."""

import os

from envtrack import cli
from envtrack.plans import jobs
from envtrack.sources.fixtures import raw_readings

from conftest import SF_SMALL


def test_load_validate_queries(spark, scratch):
    src, table = f"{scratch}/src", f"{scratch}/table"
    raw = raw_readings(spark, SF_SMALL, keep_order=True).orderBy("_part", "_seq").drop("_part", "_seq")
    raw.coalesce(2).write.option("header", True).csv(src)
    assert cli.main(["queries", table], spark) == 1  # empty table
    assert cli.main(["validate", table], spark) == 1  # not ready
    assert cli.main(["load", src, table, "--state", f"{scratch}/state", "--max-batches", "1"], spark) == 0
    assert cli.main(["load", src, table, "--state", f"{scratch}/state", "--summary", f"{scratch}/sum",
                     "--report", f"{scratch}/rep"], spark) == 0
    assert spark.read.json(f"{scratch}/rep/totals").first()["total_rows_seen"] == 1015
    assert os.path.isdir(f"{scratch}/sum/load_summary")
    assert cli.main(["validate", table, "--out", f"{scratch}/v"], spark) == 0
    assert os.path.isdir(f"{scratch}/v/example_document") and os.path.isdir(f"{scratch}/v/validation_report")
    assert spark.read.json(f"{scratch}/v/basic_statistics").count() == 5
    one = next(f"{src}/{f}" for f in sorted(os.listdir(src)) if f.endswith(".csv"))
    assert cli.main(["sample", one, f"{scratch}/sample", "--rows", "7"], spark) == 0
    assert spark.read.option("header", True).csv(f"{scratch}/sample").count() == 7
    assert cli.main(["check-quotes", src], spark) == 0
    assert cli.main(["queries", table, "--out", f"{scratch}/q"], spark) == 0
    assert os.path.isdir(f"{scratch}/q/high_smoke_readings")
    assert jobs.read_table(spark, table).count() == 956
    assert cli.main(["window", table, "--start", "2024-01-08", "--end", "2024-01-15", "--device", "dev-0001",
                     "--out", f"{scratch}/w"], spark) == 0
    got = spark.read.json(f"{scratch}/w")
    assert got.count() > 0 and {r[0] for r in got.select("device").distinct().collect()} == {"dev-0001"}
    assert cli.main(["load", f"{scratch}/nowhere", f"{scratch}/t2", "--state", f"{scratch}/s2",
                     "--max-batches", "0"], spark) == 1
