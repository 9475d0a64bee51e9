"""Command line for the jobs.

    spark-submit --py-files ledgerline.zip ledgerline/plans/cli.py extract --root /shared/run1
    python -m ledgerline.plans.cli all --source-dir /data/raw --root /shared/run1

``extract`` reads a database over JDBC (connection from ``MSSQL_*``
variables, the default) or a folder of Parquet files (``--source-dir``); ``build``,
``test`` and ``publish`` work on the folders the previous step wrote.
Exit code 1 when any table fails to extract or publish, or a data test fails.
"""

from __future__ import annotations

import argparse
import os
import sys

from ledgerline.functions import Widths
from ledgerline.operators.quality import DataQualityError


def _source(spark, args):
    if args.source_dir:
        from ledgerline.sources.files import ParquetDirSource

        return ParquetDirSource(spark, args.source_dir)
    from ledgerline.sources.jdbc import JdbcSource, connection_from_env

    return JdbcSource(spark, connection_from_env(), fetchsize=args.chunk_size,
                      max_connections=args.max_connections)


def _raw(spark, folder, fmt="parquet"):
    from ledgerline.sources.files import raw_tables

    return raw_tables(spark, folder, fmt)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerline", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("step", choices=["extract", "build", "test", "publish", "all"])
    p.add_argument("--root", help="run folder (default: <spark.checkpoint.dir>/ledgerline)")
    p.add_argument("--source-dir", help="extract from Parquet files instead of JDBC")
    p.add_argument("--tables", nargs="+", help="tables to extract or publish")
    p.add_argument("--parallel-tables", type=int, default=1,
                   help="tables extracted at once (default 1, as a database expects)")
    p.add_argument("--chunk-size", type=int, default=100_000, help="JDBC fetch size")
    p.add_argument("--master", help="Spark master for local runs")
    p.add_argument("--raw-dir", help="read raw tables for build/test from here "
                                     "(default: the extracted Parquet folder)")
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet",
                   help="format of the raw tables in --raw-dir")
    p.add_argument("--id-type", default="int",
                   help="type of the key columns (default int, the contract; bigint once keys "
                        "pass 2^31)")
    p.add_argument("--revenue-type", default="decimal(12,2)",
                   help="type of the revenue and spend sums (default decimal(12,2))")
    p.add_argument("--units-type", default="int",
                   help="type of quantities and unit sums (default int)")
    p.add_argument("--line-total-type", default="decimal(10,2)",
                   help="type of line totals (default decimal(10,2))")
    p.add_argument("--average-digits", type=int, default=10,
                   help="digits of the averages (default 10)")
    p.add_argument("--database", default="default",
                   help="database of the built tables (default: default)")
    p.add_argument("--buckets", type=int,
                   help="buckets of the mart (default: as many as shuffle partitions)")
    p.add_argument("--max-connections", type=int,
                   help="JDBC connections at a time (default: as many as tasks run)")
    args = p.parse_args(argv)

    from ledgerline.plans import jobs
    from ledgerline.session import (
        build_session,
        end_runs,
        input_bytes,
        shared_dir,
        size_shuffle_partitions,
    )
    from ledgerline.sinks.lakehouse import PublishedTables

    widths = Widths(args.id_type, args.units_type, args.line_total_type, args.revenue_type,
                    args.average_digits)
    spark = build_session(args.master)
    root = args.root or shared_dir(spark, "ledgerline")
    parquet_dir = os.path.join(root, "parquet")
    raw_dir, raw_fmt = (args.raw_dir, args.format) if args.raw_dir else (parquet_dir, "parquet")
    models_dir = os.path.join(root, "models")
    warehouse = os.path.join(root, "warehouse")
    try:
        if args.step == "all":
            done = jobs.run_all(spark, _source(spark, args), root, _raw, widths=widths,
                                tables=args.tables, parallel_tables=args.parallel_tables,
                                buckets=args.buckets, database=args.database)
            for report in ("extract_report", "data_tests", "publish_report", "store_counts"):
                done[report].show(100, truncate=False)
            return 0
        if args.step == "extract":
            report = jobs.extract(spark, _source(spark, args), parquet_dir, args.tables,
                                  args.parallel_tables)
            report.show(truncate=False)
            jobs.raise_on_extract_failure(report)
            return 0
        size_shuffle_partitions(spark, input_bytes(spark, raw_dir))
        raw = _raw(spark, raw_dir, raw_fmt)
        if args.step == "build":
            jobs.build_models(spark, raw, models_dir,
                              os.path.join(root, "output", "orders_enriched.parquet"),
                              widths, database=args.database, buckets=args.buckets)
            return 0
        models = jobs.attach_models(spark, raw, models_dir, widths, args.database)
        if args.step == "test":
            jobs.run_data_tests(models, raw).show(100, truncate=False)
        else:
            tables = args.tables or jobs.PUBLISHED_TABLES
            jobs.publish(spark, models, warehouse, tables).show(truncate=False)
            jobs.store_gate(spark, models, warehouse, tables).show(truncate=False)
            PublishedTables(spark, warehouse).tables().show(truncate=False)
    except (jobs.ExtractionFailed, DataQualityError, RuntimeError) as exc:
        print(f"error: {exc}", file=sys.stderr)
        return 1
    finally:
        end_runs(spark)
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
