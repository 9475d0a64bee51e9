"""Token-id files, embedding whitening and tokenizer alignment, against brute force."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL, plan_text
from edge_tables import edge_dir, empty_dir  # noqa: F401 - fixtures
from test_operators import key, rows
from tokenizers import Tokenizer

from ledgerline.llm import alignment, token_files, whitening
from ledgerline.llm.packing import default_tokenizer
from ledgerline.llm.queries import QUERIES
from ledgerline.session import fresh_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# --- token files -------------------------------------------------------------------


def test_bits_round_trip():
    rng = np.random.default_rng(1)
    for width in (1, 2, 5, 8, 15, 16, 17, 31, 32):
        for n in (0, 1, 63, 64, 65, 1000):
            ids = rng.integers(0, 1 << width, n).astype("<u4")
            packed = token_files.pack_bits(ids, width)
            assert len(packed) == -(-n * width // 8)
            assert (token_files.unpack_bits(packed, n, width) == ids).all()
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize("which", ["edge_dir", "sf"])
def test_token_files(spark, request, which):
    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    got = sorted(QUERIES["op11_token_files"](spark, folder).collect(), key=lambda r: r.start)
    want = brute.token_files(rows(folder), Tokenizer.from_file(default_tokenizer()))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(
        want, key=key)
    assert [key((r.doc_id,)) for r in got] == sorted(key((r.doc_id,)) for r in got)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]


def test_random_access(spark, edge_dir):
    """Any range of a file equals that range of the whole, whatever blocks it crosses."""
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    path = token_files.write_token_files(docs, fresh_dir(spark, "files"))
    rng = random.Random(2)
    for row in token_files.manifest(spark, path).collect():
        reader = token_files.Reader(row.file)
        assert reader.width == 16 and reader.ids == row.ids and len(reader.ends) == row.docs
        whole = reader.read(0, reader.ids)
        assert np.concatenate([reader.document(i) for i in range(row.docs)]).tolist() \
            == whole.tolist()
        for _ in range(50):
            a, b = sorted(rng.choices(range(row.ids + 1), k=2))
            assert reader.read(a, b).tolist() == whole[a:b].tolist()


def test_blocks_of_any_size(tmp_path):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 49408, n).astype("<u4") for n in (0, 1, 700, 64, 3, 5000, 0, 128)]
    for block in (64, 192, 1 << 14):
        path = str(tmp_path / f"{block}.tok")
        with open(path, "wb") as stream:
            writer = token_files.Writer(stream, 17, block)
            for i, ids in enumerate(texts):
                writer.add(i if i else None, ids)
            size = writer.close()
        reader = token_files.Reader(path)
        assert reader.file.size() == size
        assert [reader.document(i).tolist() for i in range(len(texts))] == [
            t.tolist() for t in texts]
        assert reader.known.tolist() == [False] + [True] * 7


def test_a_file_of_a_lost_attempt_is_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    path = token_files.write_token_files(docs, str(tmp_path / "table"))
    before = sorted(map(tuple, token_files.read_token_files(spark, path).collect()))
    (tmp_path / "table" / "data" / "part-000000-of-a-lost-attempt.tok").write_bytes(b"half")
    assert sorted(map(tuple, token_files.read_token_files(spark, path).collect())) == before


def test_one_id_on_every_row_is_spread(spark, tmp_path):
    """Equal rows meet range borders too: no file holds them all."""
    docs = spark.range(4000).selectExpr("7L AS doc_id", "'the same text' AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = token_files.write_token_files(docs, str(tmp_path / "table"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = token_files.manifest(spark, path).collect()
    assert sum(f.docs for f in files) == 4000 and max(f.docs for f in files) < 2000


# --- whitening ------------------------------------------------------------------------


def grid_rows(spark, folder: str) -> list[tuple]:
    found = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    out = []
    for r in found:
        v = r.embedding
        if v and all(c is not None and np.isfinite(c) and abs(c) < 2.0 ** 56 for c in v):
            out.append((r.vec_id, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]))
    width = max(len(x) for _, x in out)
    return [(i, x) for i, x in out if len(x) == width]


@pytest.mark.parametrize("which", ["edge_dir", "sf"])
def test_whitening(spark, request, which):
    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    data = grid_rows(spark, folder)
    want, shares = brute.whitening(data)
    got: dict = {}
    for r in QUERIES["op12_embedding_whitening"](spark, folder).collect():
        assert r.n == len({tuple(x) for _, x in data})
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
        got.setdefault(r.vec_id, []).append((r.deviation, r.component, r.whitened))
    assert set(got) == set(want)
    k = len(shares)
    signs = None
    for vec_id, vectors in want.items():
        rows_ = sorted(got[vec_id], key=lambda r: r[0])
        assert len(rows_) == k * len(vectors)
        assert sorted({d for d, *_ in rows_}) == sorted({d for d, _ in vectors})
        for deviation, w in vectors:
            mine = {c: v for d, c, v in rows_ if d == deviation}
            mine = np.array([mine[c] for c in range(1, k + 1)])
            if signs is None and np.abs(w).min() > 1e-3:
                signs = np.sign(w * mine)
            if signs is not None:
                assert mine * signs == pytest.approx(w, abs=1e-9)


def spectrum(rows_: np.ndarray, k: int = 16):
    n, width = rows_.shape
    r = whitening._triangle(iter([rows_[:40], rows_[40:]]), width)
    r = np.vstack([r, np.zeros((width - len(r), width))])
    return whitening.solve(r, whitening.Centre(n, [0] * width, 0, 0), k)


@pytest.mark.parametrize("case", ["plain", "graded", "equal", "low rank", "close", "few", "one"])
def test_solver(case):
    rng = np.random.default_rng(5)
    y = rng.standard_normal((300, 32))
    if case == "graded":
        y = y * 10.0 ** -(np.arange(32) / 3)
    if case == "equal":
        y = np.vstack([np.eye(32), -np.eye(32)])
    if case == "low rank":
        y = np.repeat(y[:, :8], 4, axis=1)
    if case == "close":
        y = np.linalg.qr(y)[0] * np.array([3, 3, 3, 2] + [1 + i * 1e-10 for i in range(28)])
        y = y @ np.linalg.qr(rng.standard_normal((32, 32)))[0]
    if case == "few":
        y = y[:5]
    if case == "one":
        y = y[:, :1]
    model = spectrum(y)
    k = {"low rank": 8, "few": 5, "one": 1}.get(case, 16)
    assert len(model.values) == k
    exact = np.linalg.svd(y, compute_uv=False)[:k] ** 2 / len(y)
    assert model.values == pytest.approx(exact, rel=1e-9 if case != "graded" else 1e-6)
    w = y @ model.directions
    assert np.abs(w.T @ w / len(y) - np.eye(k)).max() < 1e-9


def test_flat_vectors_have_no_components(spark):
    flat = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)],
                                 "vec_id long, embedding array<double>")
    assert whitening.whiten(flat).collect() == []


def test_centring_is_exact_beyond_64_bits():
    big = 1 << 61
    x = np.array([[big, -big], [big - 1, -big], [5, 7]], np.int64)
    centre = whitening.Centre(3, [int(v) for v in x.astype(object).sum(axis=0)], -big, big)
    d = centre.deviations(x)
    assert [[int(v) for v in r] for r in d] == [
        [3 * int(v) - s for v, s in zip(r, centre.sums, strict=True)] for r in x]
    small = whitening.Centre(3, [30, 33], 5, 20)
    y = np.array([[10, 11], [5, 20]], np.int64)
    assert small.deviations(y).tolist() == [[0, 0], [-15, 27]]
    assert whitening.squared_lengths(small.deviations(y)).to_pylist() == [0, 954]


def test_triangles_meet_in_a_tree(spark):
    """More parts than one fan-in: the same spectrum as all rows at once."""
    rng = np.random.default_rng(8)
    data = rng.integers(-500, 500, (400, 5))
    df = spark.createDataFrame([(r.tolist(),) for r in data], "x array<long>").repartition(20)
    centre = whitening.centre_of(df, 5)
    assert centre.sums == data.sum(axis=0).tolist() and centre.n == 400
    r = whitening.triangle_of(df, centre)
    y = data - data.mean(axis=0)
    assert r.T @ r == pytest.approx(y.T @ y)


# --- alignment --------------------------------------------------------------------------


ODD = ["", None, " ", "  ", " x", "x ", "x  ", "  x  y", "a\nb", "a \n b", "a\n\n  b\t c ",
       "tab\t x", "a b   c", "▁x ▁", "é è ñ 漢字 🎉", "<s> </s> <unk> <|endoftext|> x",
       "a\x1c b", "a \x1cb", "\x00 \x01", "don't 's", "x" * 3000, "a" + " " * 50 + "b",
       "\r\n x\r\n", "　x 　y", "é ́x", "﻿x", "a\x85 b", "same same same"]


def test_pieces_of_any_size_align_alike():
    rng = np.random.default_rng(1)
    for _ in range(150):
        end = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, end + 1, rng.integers(0, 40)), end))
                for _ in "ab")
        whole = alignment.align(a, b, 1 << 20)
        assert whole.b_at.tolist() == [int((b < e).sum()) for e in a]
        assert whole.a_at.tolist() == [int((a < e).sum()) for e in b]
        common = np.intersect1d(a, b)
        assert whole.group_a.tolist() == [int((common < e).sum()) for e in a]
        for piece in (1, 2, 3, 7):
            split = alignment.align(a, b, piece)
            i, j = alignment.diagonals(a, b, piece)
            assert max(np.diff(i + j)) <= piece + 1     # equal work
            for name in ("b_at", "a_at", "tied_a", "tied_b", "group_a", "group_b"):
                assert (getattr(split, name) == getattr(whole, name)).all()


@pytest.mark.parametrize("which", ["edge_dir", "sf"])
def test_alignment(spark, request, which):
    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    got = sorted(map(tuple, QUERIES["op13_tokenizer_alignment"](spark, folder).collect()), key=key)
    assert got == sorted(brute.alignment(rows(folder), BYTE_BPE, PIECES), key=key)


@pytest.mark.parametrize("known", [alignment.KNOWN, 300, 0])
def test_alignment_of_odd_texts_and_rare_pairs(spark, known):
    """Small tables, pieces and task memories: the joined pairs count as well."""
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choices(ODD[13:20] + ["plain", "words", "unaffordable"], k=12))
                   for _ in range(40)]
    data = list(enumerate(texts))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = alignment.align_documents(docs, BYTE_BPE, PIECES, known=known, piece=50, held=40)
    assert sorted(map(tuple, got.collect())) == brute.alignment(data, BYTE_BPE, PIECES)


def test_rare_pairs_are_joined_without_a_cross_join(spark):
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(50)],
                                 "doc_id long, text string")
    plan = plan_text(alignment.align_documents(docs, BYTE_BPE, PIECES, known=0))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
