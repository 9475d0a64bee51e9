"""The model graph as plain function calls (E2's dependency order).

    raw (sources) -> staged (views) -> orders_enriched (mart) -> 4 reports

:class:`ModelGraph` builds each model lazily, on first access, from the
models it depends on; nothing runs until an action, and Catalyst then
optimizes each requested model as one plan.  To share the mart between
several reports at run time, materialise it (see ``plans.jobs``) instead of
recomputing it per report.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerline.functions import CONTRACT, WIDE, Widths
from ledgerline.operators import marts, reports, staging
from ledgerline.session import input_stamp
from ledgerline.sources import testdata

MODEL_NAMES = (
    "stg_customers",
    "stg_orders",
    "stg_products",
    "orders_enriched",
    "rpt_revenue_by_country",
    "rpt_revenue_by_category",
    "rpt_customer_summary",
    "rpt_product_performance",
)


class ModelGraph(Mapping[str, DataFrame]):
    """All models keyed by name, built on demand from the three raw tables.

    ``widths`` default to the contract (``int`` keys, ``decimal(12,2)`` sums);
    all fail loudly on overflow under ANSI mode.  A deployment whose keys pass
    2^31 or whose totals pass 10^10 passes ``WIDE`` rather than truncating.
    """

    def __init__(self, raw: Mapping[str, DataFrame], widths: Widths = CONTRACT):
        self.raw = raw
        self.widths = widths
        self._built: dict[str, DataFrame] = {}

    def _build(self, name: str) -> DataFrame:
        w = self.widths
        if name == "stg_customers":
            return staging.stg_customers(self.raw["customers"], w)
        if name == "stg_orders":
            return staging.stg_orders(self.raw["orders"], w)
        if name == "stg_products":
            return staging.stg_products(self.raw["products"], w)
        if name == "orders_enriched":
            return marts.orders_enriched(self["stg_orders"], self["stg_customers"],
                                         self["stg_products"], w)
        built = reports.build_reports(self["orders_enriched"], self["stg_products"], w)
        return built[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in MODEL_NAMES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(MODEL_NAMES)

    def __len__(self) -> int:
        return len(MODEL_NAMES)


def register_views(models: Mapping[str, DataFrame], names=None) -> list[str]:
    """K3: expose models as temporary views for SQL users (default: all).

    Views stay lazy: ``spark.sql("select ... from stg_orders")`` is planned
    together with the view's definition, like any DataFrame.
    """
    names = list(models) if names is None else list(names)
    for name in names:
        models[name].createOrReplaceTempView(name)
    return names


def model_graph(raw: Mapping[str, DataFrame], widths: Widths = CONTRACT) -> ModelGraph:
    """:class:`ModelGraph` over the three raw tables."""
    return ModelGraph(raw, widths)


_GRAPHS: dict[tuple, tuple[dict[str, DataFrame], ModelGraph]] = {}


def testdata_graph(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], ModelGraph]:
    """Raw tables and model graph (wide types) over the test tables in ``sf_dir``.

    Reused within one application as long as the files stay the same; every
    action still scans the full tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir, input_stamp(spark, sf_dir))
    if key not in _GRAPHS:
        raw = testdata.raw_tables(spark, sf_dir)
        _GRAPHS[key] = (raw, model_graph(raw, WIDE))
    return _GRAPHS[key]


def testdata_models(spark: SparkSession, sf_dir: str) -> ModelGraph:
    """:func:`model_graph` over the test tables in ``sf_dir``."""
    return testdata_graph(spark, sf_dir)[1]
