"""``spark-submit run_job.py <job> --run-date 2024-01-02 [--properties file] [name=value ...]``"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession

from earshot.params import JobParams, read_properties
from earshot.plans import jobs
from earshot.session import COMMON, cluster_settings
from earshot.sinks.tables import preview

JOBS = {
    "train": jobs.train,
    "recommend": jobs.recommend,
    "load-listens": jobs.load_listens,
    "load-sings": jobs.load_sings,
    "load-new-listens": jobs.load_new_listens,
    "load-new-sings": jobs.load_new_sings,
}


def show(spark: SparkSession, job: str, params: JobParams) -> None:
    """The first rows of what the job produced, in key order."""
    if job == "train":
        preview(jobs.score_part(spark, params), "userId", "sourceId").show()
        return
    path = {
        "recommend": params.table_path(params.recommend_table),
        "load-listens": params.table_path(params.listen_table),
        "load-sings": params.table_path(params.sing_table),
        "load-new-listens": params.cells_path(params.listen_table),
        "load-new-sings": params.cells_path(params.sing_table),
    }[job]
    rows = spark.read.parquet(path)
    keys = [c for c in ("rowkey", "qualifier") if c in rows.columns]
    preview(rows, *keys).show(truncate=False)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="earshot")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--run-date", type=date.fromisoformat, required=True)
    parser.add_argument("--properties", type=Path)
    parser.add_argument("--input-bytes", type=int, help="size of the input, for shuffle sizing")
    parser.add_argument("--cores", type=int, default=8, help="cores of the whole cluster")
    parser.add_argument("--show", action="store_true", help="print the first 20 result rows")
    parser.add_argument("settings", nargs="*", metavar="name=value")
    args = parser.parse_intermixed_args(argv)

    properties = read_properties(args.properties.read_text()) if args.properties else {}
    properties.update(read_properties("\n".join(args.settings)))
    params = JobParams.from_properties(properties, args.run_date)

    settings = cluster_settings(args.input_bytes, args.cores) if args.input_bytes else COMMON
    builder = SparkSession.builder.appName(params.app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    try:
        print(JOBS[args.job](spark, params))
        if args.show:
            show(spark, args.job, params)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
