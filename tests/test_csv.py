"""Batch CSV source: header by name, extra columns, missing column, first-N sample."""

import os

import pytest

from envtrack import schema as S
from envtrack.sources.csv import MissingColumnsError, read_raw_csv, sample_csv, sample_head, unclosed_quotes


def _write(path, header, rows):
    with open(path, "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")


def test_read_by_name_with_extra_columns(spark, scratch):
    header = ["extra", "temp", "device", "ts", "smoke", "motion", "lpg", "light", "humidity", "co"]
    row = {"extra": "x", "temp": "22.0", "device": "dev-1", "ts": "1594512094.0", "smoke": "0.2",
           "motion": "false", "lpg": "0.1", "light": "true", "humidity": "50.0", "co": "1.0"}
    _write(f"{scratch}/a.csv", header, [[row[h] for h in header]])
    df = read_raw_csv(spark, f"{scratch}/a.csv")
    got = df.select(*S.REQUIRED_COLUMNS).first().asDict()
    assert got == {c: row[c] for c in S.REQUIRED_COLUMNS}


def test_missing_column_is_refused(spark, scratch):
    _write(f"{scratch}/b.csv", [c for c in S.REQUIRED_COLUMNS if c != "smoke"], [["1"] * 8])
    with pytest.raises(MissingColumnsError):
        read_raw_csv(spark, f"{scratch}/b.csv")


def test_sample_head(spark, scratch):
    rows = [[str(1594512094 + i), f"dev-{i % 3}", "1", "1", "true", "1", "true", "1", "1"] for i in range(50)]
    _write(f"{scratch}/c.csv", S.REQUIRED_COLUMNS, rows)
    df = read_raw_csv(spark, f"{scratch}/c.csv")
    head = sample_head(df, 10, ["ts"]).collect()
    assert [r["ts"] for r in head] == [r[0] for r in rows[:10]]
    with pytest.raises(ValueError):
        sample_head(df, 0, ["ts"])
    sample_csv(spark, f"{scratch}/c.csv", 5, f"{scratch}/sample")
    files = [f for f in os.listdir(f"{scratch}/sample") if f.endswith(".csv")]
    assert len(files) == 1
    with open(f"{scratch}/sample/{files[0]}") as fh:
        lines = fh.read().strip().split("\n")
    assert lines[0] == ",".join(S.REQUIRED_COLUMNS) and len(lines) == 6


def test_quotes_inside_cells(spark, scratch):
    with open(f"{scratch}/q.csv", "w") as fh:
        fh.write(",".join(S.REQUIRED_COLUMNS) + "\n")
        fh.write('1594512094.0,"d ""x"", 1",1,1,true,1,true,1,1\n')
        fh.write('1594512095.0,"two\nlines",1,1,true,1,true,1,1\n')
    whole = read_raw_csv(spark, f"{scratch}/q.csv", multi_line=True).collect()
    assert [r["device"] for r in whole] == ['d "x", 1', "two\nlines"]
    assert read_raw_csv(spark, f"{scratch}/q.csv").first()["device"] == 'd "x", 1'
    assert [(r["lines"]) for r in unclosed_quotes(spark, scratch, "q.csv").collect()] == [2]


def test_sample_keeps_file_order_over_many_splits(spark, scratch):
    rows = [[str(1594512094 + (i * 37) % 500), f"dev-{i}", "1", "1", "true", "1", "true", "1", "1"] for i in range(500)]
    _write(f"{scratch}/d.csv", S.REQUIRED_COLUMNS, rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        sample_csv(spark, f"{scratch}/d.csv", 333, f"{scratch}/s")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = spark.read.option("header", True).csv(f"{scratch}/s").collect()
    assert [r["device"] for r in got] == [f"dev-{i}" for i in range(333)]
