"""Connected components against a plain search."""

from __future__ import annotations

import random

import pytest

from ledgerline.llm.components import connected_components


def plain(links: list[tuple]) -> dict[int, int]:
    label = {n: n for u, v in links if None not in (u, v) and u != v for n in (u, v)}
    changed = True
    while changed:
        changed = False
        for u, v in links:
            if None not in (u, v) and u != v and label[u] != label[v]:
                label[u] = label[v] = min(label[u], label[v])
                changed = True
    return label


@pytest.mark.parametrize("shape", ["empty", "star", "path", "random"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {"empty": [(None, 1), (2, 2)],
             "star": [(5, i) for i in range(6, 30)] + [(-9, 100)],
             "path": [(i, i + 1) for i in range(40)] + [(1000 - i, 999 - i) for i in range(15)],
             "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(80)]}[shape]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == plain(links)
