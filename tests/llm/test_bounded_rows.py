"""Rows that operators make between their steps do not grow with the square of a group."""

from __future__ import annotations

import json
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerline.llm import bm25, common, near_dedup, packing, token_files
from ledgerline.llm.near_dedup import WordHashes


def test_a_query_leaves_a_task_with_k_hits_whatever_the_shards(tmp_path):
    rng = np.random.default_rng(3)
    hashes, words = WordHashes(), [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 30))).encode() for _ in range(200)]
    texts[150] = texts[30]
    docs = [(i, *bm25._terms(t, hashes)) for i, t in enumerate(texts)]
    mean = sum(d[3] for d in docs) / len(docs)
    queries = [(q, 10 * q, docs[10 * q][1].view(np.int64)) for q in range(20)]
    pq.write_table(pa.table({
        "q_row": pa.array([q for q, _, _ in queries]),
        "q_id": pa.array([i for _, i, _ in queries]),
        "terms": pa.array([t.tolist() for _, _, t in queries], pa.list_(pa.int64())),
        "idf": pa.array([(1 + t % 5).astype(float).tolist() for _, _, t in queries])}),
        str(tmp_path / "asked.parquet"))

    def found(shards: int) -> list[tuple]:
        parts = [bm25._shard(i, docs[i::shards]) for i in range(shards)]
        run = bm25._search(mean, 10, [str(tmp_path / "asked.parquet")])
        return [(r["q_row"], r["q_id"], round(r["score"], 9)) for b in run(iter(parts))
                for r in b.to_pylist()]

    one, many = found(1), found(16)
    assert len(many) == len(one) <= 10 * len(queries)
    assert sorted(many) == sorted(one)


def test_a_score_does_not_depend_on_what_else_is_scored():
    rng = np.random.default_rng(5)
    hashes = WordHashes()
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 900, 700)).encode() for _ in range(40)]
    docs = [(i, *bm25._terms(t, hashes)) for i, t in enumerate(texts)]
    shard = bm25.Shard(bm25._shard(0, docs).to_pylist()[0], 700.0)
    numbers, _ = shard.find(docs[0][1])
    idf = rng.random(len(numbers))
    together = shard.exact(numbers, idf, np.arange(40))
    alone = [shard.exact(numbers, idf, np.array([i]))[0] for i in range(40)]
    assert together.tolist() == alone


def test_queries_are_scored_together_and_exactly(monkeypatch):
    """In one product over all documents, and block by block, as each by itself."""
    rng = np.random.default_rng(9)
    hashes = WordHashes()
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 60)) % 500).encode()
             for _ in range(700)]
    docs = [(i, *bm25._terms(t, hashes)) for i, t in enumerate(texts)]
    monkeypatch.setattr(bm25, "DENSE", 40)
    shard = bm25.Shard(bm25._shard(0, docs).to_pylist()[0], 30.0)
    unknown = np.array([3, 5], np.uint64)
    asked = [(d[1], rng.random(len(d[1])) + 0.1) for d in docs[::20]] + [
        (unknown, np.ones(2)), (unknown[:0], np.ones(0))]
    want = []
    for terms, idf in asked:
        numbers, here = shard.find(terms)
        scores = shard.exact(numbers, idf[here], np.arange(shard.n))
        best = np.lexsort((shard.ids, -scores))[:10]
        best = best[scores[best] > 0]
        want.append((shard.ids[best].tolist(), scores[best].tolist()))
    least = [s[-1] if len(s) == 10 else 0.0 for _, s in want]
    for few in (1, 8, 1 << 20):
        monkeypatch.setattr(bm25, "FEW", few)
        for bounds in (least, [0.0] * len(asked)):
            got = [(i.tolist(), s.tolist()) for i, s in shard.top(asked, 10, bounds)]
            assert got == want


def test_members_that_share_many_elements_meet_once(spark):
    members = [("a", False), ("b", False), ("c", True)]
    few = spark.createDataFrame(
        [(1, e, ord(m), 100, joined, 30, 2) for m, joined in members for e in range(20)]
        + [(1, 50, ord("b"), 100, False, 30, 1), (1, 50, ord("d"), 100, True, 30, 1),
           (2, 3, ord("b"), 100, False, 30, 1), (2, 3, ord("e"), 5, True, 30, 1)],
        "g long, e long, rep long, n long, joined boolean, size long, apart long")
    pairs = [(r[0], chr(r[1]), chr(r[2])) for r in near_dedup._close(few, 80).collect()]
    assert sorted(pairs) == [(1, "a", "b"), (1, "a", "c"), (1, "b", "c"), (1, "b", "d")]


def test_words_are_encoded_without_offsets():
    tokens = packing.WordTokens(packing.default_tokenizer())
    texts = ["The thhéory, don't", "▁x <|endoftext|> 12", "", "a b"]
    want = [tokens.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]

    class Fast:
        encode_batch_fast = tokens.tokenizer.encode_batch_fast   # nothing else

    tokens.tokenizer = Fast()
    assert [tokens._encode(t).tolist() for t in texts] == want


def test_a_worker_drops_what_only_earlier_stages_used(monkeypatch):
    class Task:
        stage = 1

        def stageId(self):  # noqa: N802
            return self.stage

    task, made = Task(), []
    monkeypatch.setattr(common.TaskContext, "get", lambda: task)
    monkeypatch.setattr(common, "IDLE_S", -1.0)

    def get(name: str):
        return common.per_worker(name, lambda: made.append(name) or object())

    a, b = get("test a"), get("test b")
    assert get("test a") is a and get("test b") is b   # a stage keeps all it uses
    task.stage = 2
    assert get("test a") is a
    get("test c")
    assert get("test a") is a
    get("test b")
    assert made == ["test a", "test b", "test c", "test b"]
    monkeypatch.setattr(common, "IDLE_S", 60.0)
    task.stage = 3
    get("test c")
    assert get("test b") and made.count("test b") == 2   # used a moment ago by another stage


ODD_WORDS = ("Thhéory,", "(other)", "İ.", "x'İ)", "don't", "it's,", "'s", "(İstanbul)", "क़,",
             "Ça!", "ÉTÉ;", "Σοφίας:", "слово...", "<|endoftext|>", "(<|startoftext|>)", "12,",
             "a<|endoftext|>.", "</w>", "a1.", "é!", "\u0301,x", "ﬁ.", "각,", "ᄀ", "ᅡ!", "",
             "\u2003x,", "\U00016f40.", "º;", "__a__")


def test_words_parted_into_letters_and_signs_have_the_ids_of_the_text():
    rng = random.Random(5)
    tokens = packing.WordTokens(packing.default_tokenizer())
    for _ in range(300):
        text = " ".join(rng.choice(ODD_WORDS) + rng.choice(("", "", ".", "x", "É"))
                        for _ in range(20))
        want = tokens.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokens.ids(text.encode()), "<u4").tolist() == want


@pytest.mark.parametrize("kind", [packing.WordTokens, token_files.Tokens])
def test_letters_are_encoded_once_whatever_signs_and_case_they_come_with(kind):
    tokens = kind(packing.default_tokenizer())
    given, encode = [], tokens._encode
    tokens._encode = lambda text, *rest: given.append(text) or encode(text, *rest)
    for text in (b"Stone river", b"(stone), river... RIVER", b"\"Stone\" river,"):
        tokens.ids(text)
    assert sorted(w for text in given for w in text.split() if w.isalpha()) == ["river", "stone"]


def test_a_tokenizer_that_parts_words_otherwise_encodes_them_whole(tmp_path):
    spec = json.loads(Path(packing.default_tokenizer()).read_text(encoding="utf-8"))
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[^\s]+"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    tokens = packing.WordTokens(str(path))
    text = "The (stone), river... Ça!"
    want = tokens.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.ids(text.encode()), "<u4").tolist() == want
    assert want != packing.WordTokens(packing.default_tokenizer()).tokenizer.encode(
        text, add_special_tokens=False).ids


@pytest.mark.parametrize("width", [1, 5, 8, 15, 16, 17, 31, 32])
def test_bits_lie_least_significant_first_whatever_the_width(width):
    rng = random.Random(width)
    for n in (0, 1, 63, 64, 65, 300):
        ids = [rng.randrange(1 << width) for _ in range(n)]
        packed = token_files.pack_bits(np.array(ids, "<u4"), width)
        whole = sum(i << width * k for k, i in enumerate(ids))
        assert packed == whole.to_bytes(-(-n * width // 8), "little")
        assert token_files.unpack_bits(packed, n, width).tolist() == ids
        assert token_files.unpack_bits(packed, n, width).dtype == np.dtype("<u4")
