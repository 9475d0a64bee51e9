"""Benchmark: time the headline queries and the model build on one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line.  Each query is forced to completion with the ``noop``
sink (every row and column computed, nothing collected).  The model build
(``build_models``) is timed once, first: it writes the mart and four reports
as Parquet, as the pipeline does, and the analytics, check and publish
queries read those tables.  The model queries (``orders_enriched``,
``rpt_*``) still plan and run their whole chain from the raw tables.  A
warm-up query runs first and is not timed.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "orders_enriched",
    "rpt_revenue_by_country",
    "rpt_revenue_by_category",
    "rpt_customer_summary",
    "rpt_product_performance",
    "monthly_trend",
    "tier_counts",
    "top_customers",
    "category_share",
    "source_profile",
    "dq_not_null",
    "dq_unique",
    "dq_orphans",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ledgerline.plans.queries import QUERIES, built_models
    from ledgerline.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="ledgerline-bench",
                          shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g"})

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    run(QUERIES["table_counts"](spark, sf_dir))  # warm-up, not timed

    times: dict[str, float] = {}
    errors: dict[str, str] = {}

    def timed(name: str, action) -> None:
        t0 = time.perf_counter()
        try:
            action()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - recorded, the rest still run
            errors[name] = f"{type(exc).__name__}: {exc}"[:300]

    # E2 once, as the pipeline runs it: the analytics, check and publish
    # queries below then read the written tables instead of rebuilding them.
    timed("build_models", lambda: built_models(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda name=name: run(QUERIES[name](spark, sf_dir)))
    timed("publish_report", lambda: QUERIES["publish_report"](spark, sf_dir).collect())

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "spark": spark.version,
        "machine": platform.machine(),
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
