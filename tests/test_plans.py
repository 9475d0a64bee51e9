"""Plan properties that matter at scale: pruning, pushdown, no pairwise joins."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL, plan_text

from ledgerline.plans.queries import QUERIES


def read_schemas(plan: str) -> dict[str, str]:
    """table file -> ReadSchema of each Parquet scan in a formatted plan."""
    out = {}
    for block in plan.split("Scan parquet")[1:]:
        loc = re.search(r"Location: \w+ \[[^\]]*/(\w+)\.parquet\]", block)
        schema = re.search(r"ReadSchema: (struct<[^\n]*>)", block)
        if loc and schema:
            out.setdefault(loc.group(1), schema.group(1))
    return out


def test_report_scans_read_only_needed_columns(spark):
    plan = plan_text(QUERIES["rpt_revenue_by_country"](spark, SF_SMALL))
    schemas = read_schemas(plan)
    assert schemas["lineitem"] == "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>"
    assert "o_totalprice" not in schemas["orders"]
    assert "p_name" not in schemas["part"]
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in plan


# One window over the sorted files' row counts, one row per file.
POSITIONS = {n for n in QUERIES if n.endswith("_in_order")}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_or_python_rows(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL), "simple")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, (name, bad)
    assert "Window" not in plan or name in POSITIONS


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("dq_")))
def test_checks_scan_built_tables_not_the_joins(spark, name):
    """Raw lines and headers are read for their keys only, never joined again."""
    plan = plan_text(QUERIES[name](spark, SF_SMALL), "formatted")
    for schema in read_schemas(plan).items():
        if schema[0] in ("lineitem", "orders"):
            assert schema[1] in ("struct<l_orderkey:bigint>", "struct<o_orderkey:bigint>")
    if name != "dq_orphans" and name != "dq_suite":
        assert "Join" not in plan


def test_not_null_and_positive_take_one_pass_per_table(spark):
    from ledgerline.operators import quality
    from ledgerline.plans.queries import TEST_RAW_KEYS, _models_and_raw

    m, raw = _models_and_raw(spark, SF_SMALL)
    checks = quality.column_checks(m, raw, [*TEST_RAW_KEYS, *quality.NOT_NULL_DECLARED],
                                   quality.POSITIVE_DECLARED)
    plan = plan_text(checks, "simple").split("== Initial Plan ==")[0]
    tables = {t for t, _ in [*TEST_RAW_KEYS, *quality.NOT_NULL_DECLARED]}
    assert plan.count("FileScan parquet") == len(tables)


def test_reports_read_the_mart_without_multiplying_it(spark):
    for name in ("rpt_revenue_by_country", "rpt_revenue_by_category", "rpt_customer_summary",
                 "rpt_product_performance"):
        assert "Expand" not in plan_text(QUERIES[name](spark, SF_SMALL), "simple")
