"""Near-duplicates: what is moved and stored, and groups compared in blocks."""

from __future__ import annotations

import os
import random
import time

import brute
import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import common, near_dedup
from ledgerline.session import shared_dir


def _shuffle_files(spark) -> int:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = disk.diskBlockManager().getAllFiles().mkString("\n")
    return sum(os.path.basename(f).startswith("shuffle_") for f in files.split("\n"))


def _tables(spark) -> set[str]:
    folder = shared_dir(spark, "runs", spark.sparkContext.applicationId)
    return set(os.listdir(folder.removeprefix("file:"))) if os.path.isdir(
        folder.removeprefix("file:")) else set()


def _family(rng: random.Random, members: int, edits: tuple[int, ...]) -> list[str]:
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(members):
        text = list(base)
        for i in rng.sample(range(120), rng.choice(edits)):
            text[i] = f"n{rng.randrange(40)}"
        out.append(" ".join(text))
    return out


def test_shuffle_files_and_used_up_tables_go(spark):
    data = list(enumerate(_family(random.Random(1), 40, (1, 2, 9, 14))))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    files, tables = _shuffle_files(spark), _tables(spark)
    got = near_dedup.near_duplicates(docs)
    left = {t.rpartition("-")[0] for t in _tables(spark) - tables}
    assert "sketches" in left and "components" in left   # what the result reads
    assert not left & {"buckets", "hubs", "pairs", "classes", "texts", "near", "links"}
    for _ in range(50):   # executors are told, not waited for
        if _shuffle_files(spark) <= files:
            break
        time.sleep(0.2)
    assert _shuffle_files(spark) <= files
    assert sorted(map(tuple, got.collect())) == sorted(brute.components(data))
    assert spark.conf.get(common.CLEANUP, "false") == "false"


def test_a_table_stays_until_it_is_discarded(spark):
    kept, gone = (common.cut(spark.range(5), "mine") for _ in range(2))
    before = _tables(spark)
    common.discard(gone, spark.range(3))
    common.discard(gone)
    assert len(before - _tables(spark)) == 1 and kept.count() == 5


def test_a_text_moves_once_to_each_place(spark):
    pairs = [(0, r) for r in range(1, 301)] + [(5, 1), (5, 7), (900, 0)]
    places = near_dedup._places(spark.createDataFrame(pairs, "p long, rep long")).collect()
    at = {r.rep: {tuple(x) for x in r.places} for r in places}
    assert set(at) == {*range(301), 900}
    got = sorted((p, rep) for rep, xs in at.items() for p, _, member in xs if member)
    assert got == sorted(pairs) and sum(map(len, at.values())) == len(pairs) + 5 + 1 + 1
    for rep, xs in at.items():   # the hub's text is in each part with a member
        assert all((p, part, False) in at[p] for p, part, member in xs if member), rep


@pytest.mark.parametrize("group, block, direct", [
    (1 << 14, 128, 64), (1 << 14, 5, 64), (0, 128, 64), (0, 128, 4), (30, 6, 4)])
def test_groups_in_blocks_and_by_elements(spark, monkeypatch, group, block, direct):
    rng = random.Random(3)
    texts = _family(rng, 70, (1, 2, 4, 6, 9, 12)) + _family(rng, 20, (1, 3, 8))
    data = list(enumerate(texts))
    monkeypatch.setattr(near_dedup, "GROUP", group)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "DIRECT", direct)
    got = near_dedup.near_duplicates(
        spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute.components(data))


def _rows(members: list[tuple], lo: int, hi: int) -> pa.RecordBatch:
    """(rep, n, joined, block, delta) of one unit of group 7."""
    rep, n, joined, block, delta = zip(*members, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([7] * len(rep)), pa.array([lo] * len(rep), pa.int32()),
         pa.array([hi] * len(rep), pa.int32()), pa.array(rep, pa.int64()),
         pa.array(n, pa.int64()), pa.array(joined), pa.array(block, pa.int32()),
         pa.array(delta, pa.list_(pa.int64()))],
        names=["g", "lo", "hi", "rep", "n", "joined", "block", "delta"])


def test_links_of_many_alike_are_few_and_join_the_same():
    """500 members that are all linked: one link each, not one for each pair."""
    far = list(range(60))
    rows = [(i, 200, False, 0, [*far, 1000 + i]) for i in range(500)]
    batch = _rows(rows, 0, 0)
    near = pa.Table.from_batches(near_dedup._in_blocks(85)(
        iter([batch.slice(0, 130), batch.slice(130, 0), batch.slice(130)])))
    links = list(zip(near["u"].to_pylist(), near["v"].to_pylist(), strict=True))
    assert len(links) < 500 * (near_dedup.DIRECT + 2)
    reached, todo = set(), {0}
    while todo:
        reached |= todo
        todo = {b if a in reached else a for a, b in links
                if (a in reached) != (b in reached)}
    assert len(reached) == 500


def test_blocks_meet_each_other_and_no_member_itself():
    rng = np.random.default_rng(2)
    sets = {i: set(rng.choice(70, rng.integers(20, 60), replace=False).tolist())
            for i in range(40)}
    joined = {i: i % 5 == 0 for i in sets}
    n = {i: 130 + i for i in sets}

    def close(a: int, b: int) -> bool:
        return bool(near_dedup.linked(len(sets[a] ^ sets[b]), n[a] + n[b], 85))

    def found(of: list[int], block: dict[int, int], lo: int, hi: int) -> set:
        rows = [(i, n[i], joined[i], block[i], sorted(sets[i])) for i in of]
        out = pa.Table.from_batches(near_dedup._in_blocks(85)(iter([_rows(rows, lo, hi)])))
        return {frozenset(x) for x in zip(out["u"].to_pylist(), out["v"].to_pylist(),
                                          strict=True)}

    want = {frozenset((a, b)) for a in sets for b in sets
            if a < b and not (joined[a] and joined[b]) and close(a, b)}
    block = {i: i % 2 for i in sets}
    parts = (found([i for i in sets if block[i] == 0], block, 0, 0)
             | found([i for i in sets if block[i] == 1], block, 1, 1)
             | found(list(sets), block, 0, 1))
    assert want and parts == want == found(list(sets), dict.fromkeys(sets, 0), 0, 0)


def test_the_pipelines_stage_keeps_one_of_each_and_few_tables(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 6)
    rng = random.Random(8)
    data = list(enumerate(_family(rng, 40, (1, 3, 6, 10)) + _family(rng, 15, (0, 2))))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    tables = _tables(spark)
    got = near_dedup.one_of_each(docs)
    left = {t.rpartition("-")[0] for t in _tables(spark) - tables}
    assert not left & {"buckets", "hubs", "pairs", "classes", "texts", "near", "links"}
    assert sorted(r.doc_id for r in got.collect()) == sorted(
        data[i][0] for i in brute.one_of_each(data))
