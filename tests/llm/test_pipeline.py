"""The pipeline's stages and its result against plain Python."""

from __future__ import annotations

from collections import Counter

import brute
import duckdb
from edge_tables import edge_dir, empty_dir  # noqa: F401 - fixtures

import corpus_pipeline
from ledgerline.llm import mixing, near_dedup, packing


def _stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, folder), name)
        out.append(docs)
    return out


def test_stages_on_edges(spark, edge_dir):
    given, ruled, single, clean, mixed, packed = _stages(spark, edge_dir)
    for df in (ruled, single, clean, mixed):
        assert df.columns == given.columns and df.dtypes == given.dtypes

    judged = {r.doc_id: r.kept for r in duckdb_quality(edge_dir)}
    assert Counter(r.doc_id for r in ruled.collect()) == Counter(
        r.doc_id for r in given.collect() if judged[r.doc_id])

    rows = ruled.collect()
    data = [(r.doc_id, r.text) for r in rows]
    kept = Counter(data[i][0] for i in brute.one_of_each(data))
    assert Counter(r.doc_id for r in single.collect()) == kept
    assert {tuple(r) for r in single.collect()} <= {tuple(r) for r in rows}

    for r in clean.collect():
        assert brute.personal(r.text) == "" and r.n_chars == len(r.text)
    before = {r.doc_id: r.text for r in single.collect()}
    for r in clean.collect():
        if not brute.personal(before[r.doc_id]):
            assert r.text == before[r.doc_id]

    # Whole documents, each source within one document of its target.
    size = lambda t: len(brute.words(t))
    whole = Counter(tuple(r) for r in clean.collect())
    assert {tuple(r) for r in mixed.collect()} <= set(whole)
    targets = {r.source: r.m_target for r in mixing.mix(
        clean.select("doc_id", "source", "text"), carry=("source",)).select(
        "source", "m_target").distinct().collect()}
    for source, target in targets.items():
        sizes = [size(r.text) for r in clean.collect() if r.source == source]
        taken = sum(size(r.text) for r in mixed.collect() if r.source == source)
        assert abs(taken - target) <= max(sizes) / 2 + 1
        copies = Counter(tuple(r) for r in mixed.collect() if r.source == source)
        assert max(copies[r] / whole[r] for r in copies) <= 3

    ids = Counter(r.doc_id for r in mixed.collect())
    assert Counter(r.doc_id for r in packed.collect() if r.piece == 0) == ids


def duckdb_quality(folder):
    from collections import namedtuple

    from ledgerline.llm.quality import OP6_SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    rel = con.sql(OP6_SQL)
    row = namedtuple("row", rel.columns)
    return [row(*r) for r in rel.fetchall()]


def test_run_is_the_stages_one_after_another(spark, edge_dir):
    got = corpus_pipeline.run(spark, edge_dir)
    last = _stages(spark, edge_dir)[-1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert got.columns == last.columns
    assert sorted(map(tuple, got.select(columns).collect()), key=key) == sorted(
        map(tuple, last.select(columns).collect()), key=key)
    by_sequence = Counter()
    for r in got.collect():
        by_sequence[r.sequence_id] += r.length
    assert max(by_sequence.values()) <= packing.CAPACITY


def test_empty_table(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def _texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, d_h long, row string, k_id int")
    return Counter((r.doc_id, r.text) for r in near_dedup.one_of_each(docs).collect())


def test_every_text_stays_once(spark):
    """An id on several texts links none of them; no clean text goes with an id."""
    prose = {c: " ".join(f"{c}{i}" for i in range(120)) for c in "ABCZ"}
    rows = [(i, prose[c], 7, "x", 1) for i, c in
            ((1, "A"), (5, "A"), (5, "B"), (9, "C"), (9, "Z"), (12, "B"))]
    assert _texts(spark, rows) == Counter(
        {(1, prose["A"]): 1, (5, prose["B"]): 1, (9, prose["C"]): 1, (9, prose["Z"]): 1})
    # Without ids, and equal rows many times over.
    rows = [(None, prose["A"], 7, "x", 1)] * 3 + [(None, prose["B"], 7, "x", 1)] * 2
    rows += [(4, prose["B"], i, "y", 2) for i in range(40)] + [(4, prose["C"], 0, None, None)]
    assert _texts(spark, rows) == Counter(
        {(None, prose["A"]): 1, (4, prose["B"]): 1, (4, prose["C"]): 1})
    # Rows without words are no copies of one another.
    rows = [(1, None, 0, "", 0), (2, "", 0, "", 0), (2, " ", 0, "", 0), (3, prose["A"], 0, "", 0)]
    assert sum(_texts(spark, rows).values()) == 4


def test_near_copies_with_repeated_ids(spark):
    import random

    rng = random.Random(5)
    rows = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(90)]
        for _ in range(7):
            text = list(base)
            for i in rng.sample(range(90), rng.choice((0, 1, 2, 3))):
                text[i] = f"x{rng.randrange(10**6)}"
            rows.append((rng.choice([None, 1, 2, 3, 4]), " ".join(text), 0, "", 0))
    got = _texts(spark, rows)
    want = Counter(rows[i][0] for i in brute.one_of_each([r[:2] for r in rows]))
    assert Counter(i for i, _ in got.elements()) == want


def test_links_of_one_id_with_several_texts(spark):
    """op3's classes are nodes of their own, compared by their own texts."""
    prose = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "AB"}
    near = prose["B"] + " tail"
    rows = [(1, prose["A"]), (2, prose["A"]), (1, near), (7, prose["B"]), (2, "short one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.d_id, r.d_n, r.d_component) for r in
                 near_dedup.near_duplicates(docs).collect())
    assert got == sorted(brute.components(rows))
