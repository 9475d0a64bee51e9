"""``bucket`` agrees with ``pandas.cut`` (right-closed bins) on any value."""

from __future__ import annotations

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.functions import SPEND_TIER_BOUNDS, SPEND_TIER_LABELS, bucket

EDGES = [0.0, 500.0, 2000.0, 5000.0]
values = st.lists(
    st.one_of(st.sampled_from(EDGES + [v + d for v in EDGES for d in (-0.01, 0.01)]),
              st.floats(min_value=-1e6, max_value=1e7, allow_nan=False),
              st.none()),
    min_size=1, max_size=60)


@settings(max_examples=25, deadline=None)
@given(values)
def test_bucket_matches_pandas_cut(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r[1] for r in df.select("i", bucket("v")).orderBy("i").collect()]
    cut = pd.cut(pd.Series(vals, dtype="float64"), bins=list(SPEND_TIER_BOUNDS),
                 labels=list(SPEND_TIER_LABELS))
    want = [None if (isinstance(x, float) and math.isnan(x)) or pd.isna(x) else str(x)
            for x in cut]
    assert got == want
