from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app_name="ledgerline-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def seed_models(spark):
    from seed import raw_seed

    from ledgerline.plans.models import model_graph

    raw = raw_seed(spark)
    return model_graph(raw), raw


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as printed by ``explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
