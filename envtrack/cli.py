"""Command line: ``python -m envtrack {load,validate,queries} ...`` (or under ``spark-submit``).

Exit status follows the three jobs it replaces: 0 on success (a load stopped by ``--max-batches``
is a success), 1 when a load fails or is refused, when validation finds an empty or unready table,
and when queries are asked of an empty table.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="envtrack", description="Sensor telemetry jobs on Spark.")
    sub = p.add_subparsers(dest="command", required=True)

    load = sub.add_parser("load", help="load CSV files into the readings table in recoverable batches")
    load.add_argument("source", help="folder of CSV files")
    load.add_argument("table", help="path of the day-partitioned Parquet readings table")
    load.add_argument("--state", default=None, help="state folder (default: under spark.checkpoint.dir)")
    load.add_argument("--max-batches", type=int, default=None, help="stop successfully after this many batches")
    load.add_argument("--reset-checkpoint", action="store_true", help="start a new state generation; keep the table")
    load.add_argument("--checkpoint-path", default=None, help="stream checkpoint folder")
    load.add_argument("--files-per-batch", type=int, default=1, help="files per micro-batch")
    load.add_argument("--batch-size", type=int, default=None,
                      help="cut the CSV file(s) into batches of this many rows (staged once), one batch per trigger")
    load.add_argument("--batches-per-trigger", type=int, default=1,
                      help="with --batch-size and without --max-batches: row batches per micro-batch")
    load.add_argument("--multi-line", action="store_true", help="quoted cells may hold line breaks (one task a file)")
    load.add_argument("--source-url", default=None, help="where the readings come from, stored with each of them")
    load.add_argument("--source-dataset", default=None, help="name of the dataset, stored with each reading")
    load.add_argument("--report", default=None, help="write the cumulative quality report to this folder")
    load.add_argument("--summary", default=None, help="write the load summary as JSON to this folder")

    sample = sub.add_parser("sample", help="first rows of a CSV file, in file order")
    sample.add_argument("source", help="a CSV file")
    sample.add_argument("out", help="folder for the sample")
    sample.add_argument("--rows", type=int, default=10_000)

    quotes = sub.add_parser("check-quotes", help="lines that only --multi-line reads right")
    quotes.add_argument("source", help="folder of CSV files")

    val = sub.add_parser("validate", help="validation report of the readings table")
    val.add_argument("table")
    val.add_argument("--out", default=None, help="write the report as JSON to this folder")

    win = sub.add_parser("window", help="readings of some devices in a time window [start, end)")
    win.add_argument("table")
    win.add_argument("--start", required=True, help="first day (YYYY-MM-DD, UTC)")
    win.add_argument("--end", required=True, help="day after the last one (YYYY-MM-DD, UTC)")
    win.add_argument("--device", action="append", default=None, help="device id (repeatable; default: all)")
    win.add_argument("--valid-only", action="store_true", help="readings without quality flags only")
    win.add_argument("--out", default=None, help="write the readings as JSON to this folder")

    q = sub.add_parser("queries", help="run the published example queries")
    q.add_argument("table")
    q.add_argument("--out", default=None, help="write each result as JSON under this folder")
    q.add_argument("--valid-only", action="store_true", help="use readings without quality flags only")
    return p


def _load(args: argparse.Namespace, spark: SparkSession) -> int:
    from envtrack import schema as S
    from envtrack.operators.transform import SourceLabels
    from envtrack.plans import jobs
    from envtrack.sources.csv import MissingColumnsError
    from envtrack.sources.manifest import SourceChangedError
    from envtrack.streaming import load as L

    common = {"max_batches": args.max_batches, "reset": args.reset_checkpoint, "checkpoint_path": args.checkpoint_path,
              "multi_line": args.multi_line,
              "labels": SourceLabels(dataset=args.source_dataset or S.SOURCE_DATASET, url=args.source_url)}
    try:
        if args.batch_size is not None:
            summary = L.load_in_row_batches(spark, args.source, args.table, args.state, batch_size=args.batch_size,
                                            batches_per_trigger=args.batches_per_trigger, **common)
        else:
            summary = L.load_readings(spark, args.source, args.table, args.state,
                                      files_per_batch=args.files_per_batch, **common)
    except (L.LoadFailed, SourceChangedError, MissingColumnsError, ValueError) as exc:
        print(f"ERROR: {exc}", file=sys.stderr)
        return 1
    if args.summary:
        jobs.write_reports({"load_summary": jobs.load_summary_frame(spark, summary)}, args.summary)
    if args.report:
        paths = L.load_state(spark, args.table, args.state, args.checkpoint_path)
        jobs.write_reports(L.load_report(spark, paths), args.report)
    print(json.dumps(summary.as_dict(), default=str))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"envtrack-{args.command}").getOrCreate()
    from envtrack.plans import jobs

    if args.command == "load":
        return _load(args, spark)

    if args.command == "sample":
        from envtrack.sources.csv import MissingColumnsError, sample_csv

        try:
            sample_csv(spark, args.source, args.rows, args.out)
        except (MissingColumnsError, ValueError) as exc:
            print(f"ERROR: {exc}", file=sys.stderr)
            return 1
        return 0

    if args.command == "check-quotes":
        from envtrack.sources.csv import unclosed_quotes

        files, lines = unclosed_quotes(spark, args.source).selectExpr("count(*)", "coalesce(sum(lines), 0)").first()
        print(f"{lines} lines with an unclosed quote in {files} files")
        return 1 if lines else 0

    if args.command == "validate":
        reports = jobs.validation_reports(spark, args.table)
        if args.out:
            reports = jobs.write_reports(reports, args.out)
        row = reports["validation_report"].first()
        print(json.dumps(row.asDict(), default=str))
        return 0 if jobs.is_ready(row) else 1

    if args.command == "window":
        import datetime as _dt

        from pyspark.sql import functions as F

        start, end = _dt.date.fromisoformat(args.start), _dt.date.fromisoformat(args.end)
        rows = jobs.read_window(spark, args.table, start, end, args.device)
        if args.valid_only:
            rows = rows.where(F.col("is_valid"))
        if args.out:
            rows.write.mode("overwrite").json(args.out)  # may be large: one file per task
        print("readings", rows.count())
        return 0

    table = jobs.read_table(spark, args.table)
    if table.limit(1).count() == 0:
        print("ERROR: the readings table is empty; load data first.", file=sys.stderr)
        return 1
    results = jobs.run_all(spark, args.table, valid_only=args.valid_only)
    if args.out:
        results = jobs.write_reports(results, args.out)
    for name, df in results.items():
        print(name, df.count())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
