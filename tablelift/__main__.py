"""Command line: run an export job spec, print the run report, optionally verify the outputs.

    python -m tablelift -config job.toml [-report /shared/runlog] [-verify] [-master local[*]]

Exit status: 0 when every table exported (and verified, with -verify); 1 when any table failed;
2 when the job spec is invalid or a database cannot be reached (nothing was exported).
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tablelift", description="Export tables to Parquet / Arrow with Spark.")
    p.add_argument("-config", "--config", help="job spec (TOML)")
    p.add_argument("--log-level", default="info", choices=["debug", "info", "warn", "error"],
                   help="Spark log level")
    p.add_argument("--version", action="store_true", help="print the version and exit")
    p.add_argument("-report", "--report", default=None, help="append the run report to this Parquet path")
    p.add_argument("--resume", default=None, choices=["off", "unchanged", "done"],
                   help="with -report: keep what the stored run log lists as exported")
    p.add_argument("-verify", "--verify", action="store_true", help="reconcile every output with its source")
    p.add_argument("-diff", "--diff", default=None,
                   help="with -verify: write the row diff of every failing table under this folder")
    p.add_argument("-master", "--master", default=None, help="Spark master (default: from the environment)")
    args = p.parse_args(argv)
    if args.version:
        from tablelift import __version__

        print(__version__)
        return 0
    if not args.config:
        p.error("--config is required")

    from tablelift.plans.export import ExportJob, JobSpecError, run
    from tablelift.session import get_spark

    try:
        job = ExportJob.from_toml(args.config)
    except JobSpecError as e:
        print(e, file=sys.stderr)
        return 2
    if args.resume:
        job.global_.resume = args.resume
    spark = get_spark(args.master, app="tablelift")
    spark.sparkContext.setLogLevel(args.log_level.upper())
    try:
        report = run(spark, job, report_path=args.report)
    except (ConnectionError, JobSpecError) as e:
        print(e, file=sys.stderr)
        return 2
    rows = report.select("task", "table_name", "status", "rows", "seconds", "error_code", "error",
                         "scan_partitions").collect()
    for r in rows:
        line = (f"{r['task']:>10} {r['table_name'][:40]:40} {r['status']:6} rows={r['rows']} "
                f"tasks={r['scan_partitions']} {r['seconds']:.2f}s")
        if r["error_code"]:
            line += f" {r['error_code']} {r['error']}"
        print(line)
    from tablelift.plans.export import report_summary

    s = report_summary(report).first()
    print(f"tables={s['tables']} failed={s['failed']} rows={s['rows']} table_seconds={s['seconds']:.2f}")
    failed = any(r["status"] == "failed" for r in rows)
    if args.verify:
        from tablelift.plans.verify_job import verify_and_diff, verify_job

        checks = verify_and_diff(spark, job, report, args.diff) if args.diff else verify_job(spark, job, report)
        for v in checks.collect():
            line = (f"verify {v['db']}:{v['table_name'][:40]} rows {v['source_rows']}/{v['output_rows']} "
                    f"columns={v['columns_checked']} ok={v['ok']}")
            if args.diff and v["diff_path"]:
                line += f" diff_rows={v['diff_rows']} diff={v['diff_path']}"
            print(line)
            failed = failed or not v["ok"]
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
