"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local cores.  Every query
runs once to warm up and once for the clock; results are computed in full and
thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from earshot.operators import als  # noqa: E402
from earshot.operators.evaluate import rmse  # noqa: E402
from earshot.operators.split import hash_split  # noqa: E402
from earshot.operators.topk import recommend_for_all_users  # noqa: E402
from earshot.params import AlsParams, JobParams  # noqa: E402
from earshot.plans import jobs  # noqa: E402
from earshot.registered import standins  # noqa: E402
from earshot.registered.spark_queries import QUERIES, RUN_DATE, fit_model  # noqa: E402
from earshot.session import local_session  # noqa: E402
from earshot.workspace import scratch_root  # noqa: E402

HEADLINE = [
    "parse_ratings",
    "quarantine_counts",
    "dated_inputs",
    "split_counts",
    "split_by_date_members",
    "baseline_predictions",
    "bias_predictions",
    "score_pairs",
    "rmse_scored_pairs",
    "topk_scores",
    "topk_unrated",
    "upsert_last_write",
    "merged_loads",
    "cells_looked_up",
    "listen_wide_rows",
    "sing_wide_rows",
    "recommend_cells",
    "dated_overwrite",
    "job_train",
    "job_recommend",
    "job_load_listens",
    "job_load_sings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app_name="earshot-bench")

    def consume(frame: DataFrame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    def timed(run: Callable[[], object]) -> float:
        run()
        start = time.monotonic()
        run()
        return round(time.monotonic() - start, 3)

    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(lambda name=name: consume(QUERIES[name](spark, sf_dir)))

    # The parts of a training run, each on stored input.
    fitted = fit_model(spark, sf_dir)
    path = scratch_root(spark, "bench-model")
    als.save(fitted, path)
    model = als.load(path)

    def training(rows: DataFrame) -> DataFrame:
        return hash_split(rows).where("split = 'train'").drop("split").checkpoint()

    ratings = training(standins.ratings(spark, sf_dir))
    events = training(standins.event_ratings(spark, sf_dir))
    n_ratings, n_events = ratings.count(), events.count()
    seconds["als_fit_orders"] = timed(
        lambda: als.fit(ratings, AlsParams(), n_ratings).userFactors.count()
    )
    seconds["als_fit_events"] = timed(
        lambda: als.fit(events, AlsParams(), n_events).userFactors.count()
    )
    seconds["als_rmse"] = timed(lambda: rmse(als.predict(model, ratings)).first())
    # The job by itself; the query of that name also checks it against a second run.
    params = JobParams(storage_root=scratch_root(spark, "bench-job"), run_date=RUN_DATE)
    als.save(model, params.model_path)
    seconds["jobs_recommend"] = timed(lambda: jobs.recommend(spark, params))
    seconds["recommend_all_users"] = timed(lambda: consume(recommend_for_all_users(model, 5)))

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
