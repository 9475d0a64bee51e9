"""Data-quality checks (Q1-Q11).

Each check returns a small DataFrame with the columns
``(check_name, table_name, column_name, failing_rows)``; a suite is their
``unionByName`` and :func:`gate` raises when any count is above zero.

All checks are distributed aggregates: a whole table's NULL counts come from
one pass, or were taken while the table was written; uniqueness checks
aggregate per key before they shuffle, orphans are looked up in a set of bits,
and only the per-check counts (one row per declared check) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import keysets
from ledgerline.sources.schemas import REQUIRED_COLUMNS

CHECK_COLUMNS = ("check_name", "table_name", "column_name", "failing_rows")

# The declared model tests -- (table, column) pairs.
NOT_NULL_DECLARED: tuple[tuple[str, str], ...] = (
    ("stg_customers", "customer_id"),
    ("stg_products", "product_id"),
    ("stg_orders", "order_id"),
    ("orders_enriched", "order_id"),
    ("rpt_revenue_by_country", "country"),
    ("rpt_revenue_by_country", "year"),
    ("rpt_revenue_by_country", "month"),
    ("rpt_revenue_by_country", "total_revenue"),
    ("rpt_revenue_by_category", "category"),
    ("rpt_revenue_by_category", "total_revenue"),
    ("rpt_revenue_by_category", "units_sold"),
    ("rpt_customer_summary", "customer_id"),
    ("rpt_customer_summary", "customer_name"),
    ("rpt_customer_summary", "total_spend"),
    ("rpt_customer_summary", "total_orders"),
    ("rpt_product_performance", "product_id"),
    ("rpt_product_performance", "product_name"),
    ("rpt_product_performance", "total_revenue"),
    ("rpt_product_performance", "stock_remaining"),
)
UNIQUE_DECLARED: tuple[tuple[str, str], ...] = (
    ("stg_customers", "customer_id"),
    ("stg_products", "product_id"),
    ("stg_orders", "order_id"),
    ("orders_enriched", "order_id"),
    ("rpt_revenue_by_category", "category"),
    ("rpt_customer_summary", "customer_id"),
    ("rpt_product_performance", "product_id"),
)
# Primary keys of the raw files (NULL check before staging).
RAW_KEYS: tuple[tuple[str, str], ...] = (
    ("customers", "customer_id"),
    ("products", "product_id"),
    ("orders", "order_id"),
)
# What must be > 0; the flag says whether NULL also fails.
POSITIVE_DECLARED: tuple[tuple[str, str, bool], ...] = (
    ("products", "unit_price", False),
    ("orders_enriched", "line_total", True),
    ("rpt_customer_summary", "total_spend", True),
    ("rpt_revenue_by_category", "total_revenue", True),
    ("rpt_product_performance", "total_revenue", True),
    ("rpt_revenue_by_country", "total_revenue", True),
)
# Minimum row counts per model.
MIN_ROWS: dict[str, int] = {
    "orders_enriched": 18,
    "rpt_revenue_by_country": 1,
    "rpt_revenue_by_category": 1,
    "rpt_customer_summary": 8,
    "rpt_product_performance": 8,
}


class DataQualityError(AssertionError):
    """Raised by :func:`gate` when a check finds failing rows."""


def _rows(check: str, table: str, counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unfold a one-row ``counts`` frame (one column per checked column)."""
    rows = F.array(*[
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(f"`{c}`").cast("bigint").alias("failing_rows"),
        )
        for c in columns
    ])
    return counts.select(F.inline(rows))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Q2: number of non-NULL values that occur more than once.

    ``groupBy`` aggregates partially per task, so a value repeated across a
    third of the table is one row per task before the shuffle.
    """
    dups = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias(column))
    )
    return _rows("unique", table, dups, [column])


def orphans(fact: DataFrame, dim: DataFrame, key: str, fact_table: str, dim_table: str) -> DataFrame:
    """Fact rows whose non-NULL ``key`` is missing from ``dim``.

    Integer keys are looked up in the dimension's key set, a bit for each key:
    the fact is not shuffled where the set is small, and only by bits where it
    is not (``keysets.missing``).  Other keys are reduced to one row per key
    with its row count, and the anti join moves those.
    """
    if keysets.holds_integers(fact, key) and keysets.holds_integers(dim, key):
        lost = keysets.missing(fact.select(key), key, keysets.key_set(dim, key))
        counts = lost.agg(F.count(F.lit(1)).alias(key))
    else:
        per_key = (fact.where(F.col(key).isNotNull()).groupBy(key)
                   .agg(F.count(F.lit(1)).alias("n")))
        lost = per_key.join(dim.select(key), key, "left_anti")
        counts = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(key))
    return _rows(f"orphan:{dim_table}", fact_table, counts, [key])


def either_null(df: DataFrame, table: str, a: str, b: str) -> DataFrame:
    """rows where either of two keys is NULL."""
    counts = df.agg(F.count_if(F.col(a).isNull() | F.col(b).isNull()).alias(f"{a}|{b}"))
    return _rows("fk_not_null", table, counts, [f"{a}|{b}"])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


Keys = Sequence[tuple[str, str]]


def _source(models: Mapping[str, DataFrame], raw: Mapping[str, DataFrame] | None,
            table: str) -> DataFrame:
    return raw[table] if raw is not None and table in raw else models[table]


def _checks_of(nulls: Keys, positives: Sequence[tuple[str, str, bool]]
               ) -> dict[str, dict[tuple[str, str], Column]]:
    """For each table: (check, column) -> the condition of a failing row."""
    tables: dict[str, dict[tuple[str, str], Column]] = {}
    for t, c in nulls:
        tables.setdefault(t, {})["not_null", c] = F.col(c).isNull()
    for t, c, null_fails in positives:
        bad = (F.col(c) <= 0) | F.col(c).isNull() if null_fails else F.col(c) <= 0
        tables.setdefault(t, {})["positive_not_null" if null_fails else "positive", c] = bad
    return tables


def metrics_of(table: str) -> dict[str, Column]:
    """The declared NULL and positive-value counts of ``table`` as aggregates by
    ``check:column``, to be taken while the table is written."""
    checks = _checks_of(NOT_NULL_DECLARED, POSITIVE_DECLARED).get(table, {})
    return {f"{check}:{column}": F.count_if(bad) for (check, column), bad in checks.items()}


#: Counts taken while tables were written, see :func:`observed_checks`.
OBSERVED = "table_name string, check_name string, column_name string, failing_rows bigint"


def observed_checks(spark: SparkSession, taken: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``{table: {"rows": n, "check:column": failing rows}}`` as check rows; the
    number of rows is the check ``rows`` of column ``*``."""
    rows = [(t, *(("rows", "*") if k == "rows" else k.split(":", 1)), n)
            for t, counts in taken.items() for k, n in counts.items()]
    if not rows:
        return spark.createDataFrame([], OBSERVED)
    # One small partition, made in place.
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*(F.struct(
        F.lit(t).alias("table_name"), F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"), F.lit(n).cast("bigint").alias("failing_rows"))
        for t, check, column, n in rows))))


def column_checks(models: Mapping[str, DataFrame], raw: Mapping[str, DataFrame] | None,
                  nulls: Keys, positives: Sequence[tuple[str, str, bool]],
                  observed: DataFrame | None = None) -> DataFrame:
    """NULL and positive-value counts of every table, one pass over each.

    Tables of which ``observed`` holds all the asked counts are not read again.
    """
    taken = {(r["table_name"], r["check_name"], r["column_name"])
             for r in observed.collect()} if observed is not None else set()
    frames = []
    for t, checks in _checks_of(nulls, positives).items():
        asked = {(t, *key) for key in checks}
        if asked <= taken:
            names = [f"{check}:{column}" for check, column in checks]
            frames.append(observed.where(
                (F.col("table_name") == t)
                & F.concat_ws(":", "check_name", "column_name").isin(names))
                .select(*CHECK_COLUMNS))
            continue
        counts = _source(models, raw, t).agg(*(
            F.count_if(bad).alias(f"n{i}") for i, bad in enumerate(checks.values())))
        frames.append(counts.select(F.inline(F.array(*(
            F.struct(F.lit(check).alias("check_name"), F.lit(t).alias("table_name"),
                     F.lit(c).alias("column_name"),
                     F.col(f"n{i}").cast("bigint").alias("failing_rows"))
            for i, (check, c) in enumerate(checks))))))
    return union_all(frames)


def declared_not_null(models: Mapping[str, DataFrame],
                      raw: Mapping[str, DataFrame] | None = None,
                      raw_keys: Keys = RAW_KEYS, observed: DataFrame | None = None) -> DataFrame:
    """The 19 declared ``not_null`` tests (+ raw keys), one pass per table."""
    keys = [*(raw_keys if raw is not None else ()), *NOT_NULL_DECLARED]
    return column_checks(models, raw, keys, (), observed)


def declared_unique(models: Mapping[str, DataFrame], raw: Mapping[str, DataFrame] | None = None,
                    keys: Keys = UNIQUE_DECLARED) -> DataFrame:
    """The declared ``unique`` tests."""
    return union_all(unique(_source(models, raw, t), t, c) for t, c in keys)


def declared_positive(models: Mapping[str, DataFrame], raw: Mapping[str, DataFrame],
                      observed: DataFrame | None = None) -> DataFrame:
    """Positive-value tests on prices, line totals, spend and revenue."""
    return column_checks(models, raw, (), POSITIVE_DECLARED, observed)


def referential(models: Mapping[str, DataFrame],
                raw: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Orders whose customer or product is unknown, and NULL keys in the mart.

    Where ``raw`` has lines and headers apart, also the lines whose header is
    missing: the join that puts them together drops them without a word.
    """
    o, frames = models["stg_orders"], []
    if raw is not None and "order_lines" in raw:
        frames.append(orphans(raw["order_lines"], raw["order_headers"], "order_id",
                              "order_lines", "order_headers"))
    return union_all([
        *frames,
        orphans(o, models["stg_customers"], "customer_id", "stg_orders", "stg_customers"),
        orphans(o, models["stg_products"], "product_id", "stg_orders", "stg_products"),
        either_null(models["orders_enriched"], "orders_enriched", "customer_id", "product_id"),
    ])


def counted_rows(table: str, df: DataFrame, observed: DataFrame | None) -> DataFrame:
    """``row_count`` of one table: as counted while it was written, else now."""
    if observed is not None:
        found = observed.where((F.col("table_name") == table) & (F.col("check_name") == "rows"))
        if found.take(1):
            return found.select(F.col("failing_rows").alias("row_count"))
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def row_counts(models: Mapping[str, DataFrame], min_rows: Mapping[str, int] = MIN_ROWS,
               exact: Mapping[str, int] | None = None,
               observed: DataFrame | None = None) -> DataFrame:
    """Q7/Q8: row count per table against a minimum (and optional exact) count."""
    exact = exact or {}
    parts = []
    names = list(min_rows) + [t for t in exact if t not in min_rows]
    for name in names:
        n, lo = F.col("row_count"), int(min_rows.get(name, 0))
        ok = n >= F.lit(lo)
        if name in exact:
            ok = ok & (n == F.lit(int(exact[name])))
        parts.append(counted_rows(name, models[name], observed).select(
            F.lit(name).alias("table_name"), n,
            F.lit(lo).cast("bigint").alias("min_rows"), ok.alias("passed")))
    return union_all(parts)


def counts_match(left: Mapping[str, DataFrame], right: Mapping[str, DataFrame]) -> DataFrame:
    """Q11: per table, the row counts in two stores and whether they agree.

    Both sides are labelled one-row counts (``UNION ALL``), joined on the
    table name; a table missing from one side counts as a mismatch.
    """
    def labelled(tables, col):
        return union_all(
            df.agg(F.count(F.lit(1)).alias(col)).select(F.lit(n).alias("table_name"), col)
            for n, df in tables.items()
        )

    joined = labelled(left, "left_rows").join(labelled(right, "right_rows"), "table_name", "full")
    return joined.select(
        "table_name", "left_rows", "right_rows",
        F.coalesce(F.col("left_rows") == F.col("right_rows"), F.lit(False)).alias("matched"),
    )


def required_columns(df: DataFrame, table: str, required: Sequence[str]) -> list[str]:
    """Q9: required columns missing from ``df`` (extra columns allowed)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def _literal_rows(spark: SparkSession, check: str, failing: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(
        [(check, t, "*", int(n)) for t, n in failing.items()],
        "check_name string, table_name string, column_name string, failing_rows bigint")


def column_contract(spark: SparkSession, tables: Mapping[str, DataFrame],
                    required: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q9 as check rows: the number of required columns that a table lacks."""
    return _literal_rows(spark, "required_columns", {
        t: len(required_columns(tables[t], t, columns)) for t, columns in required.items()})


def count_contract(tables: Mapping[str, DataFrame], minimum: Mapping[str, int],
                   exact: Mapping[str, int], observed: DataFrame | None = None) -> DataFrame:
    """Q7/Q8 as check rows: rows short of the minimum, or off the exact count."""
    n = F.col("row_count")
    wanted = [*(("min_rows", t, F.greatest(F.lit(0), F.lit(k) - n)) for t, k in minimum.items()),
              *(("exact_rows", t, F.abs(F.lit(k) - n)) for t, k in exact.items())]
    return union_all(counted_rows(t, tables[t], observed).select(
        F.lit(check).alias("check_name"), F.lit(t).alias("table_name"),
        F.lit("*").alias("column_name"), off.cast("bigint").alias("failing_rows"))
        for check, t, off in wanted)


def store_contract(models: Mapping[str, DataFrame], store, tables: Sequence[str]) -> DataFrame:
    """Q10/Q11 as check rows: tables that are not published, and the difference
    between the built and the published number of rows."""
    spark = next(iter(models.values())).sparkSession
    there = [t for t in tables if store.exists(t)]
    rows = [_literal_rows(spark, "table_exists", {t: t not in there for t in tables})]
    if there:
        counts = counts_match({t: models[t] for t in there}, {t: store.read(t) for t in there})
        rows.append(counts.select(
            F.lit("store_rows").alias("check_name"), "table_name",
            F.lit("*").alias("column_name"),
            F.abs(F.coalesce("left_rows", F.lit(0)) - F.coalesce("right_rows", F.lit(0)))
            .alias("failing_rows")))
    return union_all(rows)


def suite(models: Mapping[str, DataFrame], raw: Mapping[str, DataFrame],
          raw_keys: Keys = RAW_KEYS, unique_keys: Keys = UNIQUE_DECLARED,
          required: Mapping[str, Sequence[str]] | None = None,
          minimum: Mapping[str, int] = MIN_ROWS, exact: Mapping[str, int] | None = None,
          store=None, published: Sequence[str] = (),
          observed: DataFrame | None = None) -> DataFrame:
    """Every check above as one DataFrame (check, table, column, failing_rows).

    Lost columns come first and alone: the other checks could not be planned
    without them.  ``store``: also compare ``published`` tables with it.
    ``observed``: counts taken when the tables were written, in place of a pass.
    """
    spark = next(iter(raw.values())).sparkSession
    columns = column_contract(spark, raw, REQUIRED_COLUMNS if required is None else required)
    if columns.filter("failing_rows > 0").take(1):
        return columns
    parts = [
        columns,
        column_checks(models, raw, [*raw_keys, *NOT_NULL_DECLARED], POSITIVE_DECLARED, observed),
        declared_unique(models, raw, unique_keys),
        referential(models, raw),
        count_contract(models, minimum, exact or {}, observed),
    ]
    if store is not None:
        parts.append(store_contract(models, store, published))
    return union_all(parts)


def gate(results: DataFrame, allow: Iterable[tuple[str, str, str]] = ()) -> list[tuple]:
    """Raise :class:`DataQualityError` if any check has failing rows.

    ``allow`` lists ``(check_name, table_name, column_name)`` triples that may
    fail (known and accepted).  Returns the failing rows otherwise.  Only the
    per-check summary rows are collected.
    """
    allowed = set(allow)
    failing = [
        tuple(r) for r in results.where(F.col("failing_rows") > 0).collect()
        if (r["check_name"], r["table_name"], r["column_name"]) not in allowed
    ]
    if failing:
        lines = "\n".join(f"  {c} {t}.{col}: {n}" for c, t, col, n in failing)
        raise DataQualityError(f"{len(failing)} data-quality check(s) failed:\n{lines}")
    return failing
