"""Every operator on the edge tables and on empty ones, against SQL or brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from edge_tables import edge_dir, empty_dir  # noqa: F401 - fixtures

from ledgerline.llm import bm25, language_model, near_dedup, packing, pii, toxicity
from ledgerline.llm.queries import ORACLE, QUERIES
from tools.check_oracle import rows_of

TABLES = ("documents", "labels", "pages")


def rows(folder: str) -> list[tuple]:
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()


def key(row) -> tuple:
    return tuple((x is None, x if x is not None else 0) for x in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("which", ["edge_dir", "empty_dir", "sf"])
def test_matches_sql(spark, request, name, which):
    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, folder)
    want = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_empty_table(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("which", ["edge_dir", "sf"])
def test_packing(spark, request, which):
    from tokenizers import Tokenizer

    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    got = QUERIES["op1_best_fit_packing"](spark, folder).collect()
    want = brute.pieces(rows(folder), Tokenizer.from_file(packing.default_tokenizer()))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in map(sorted, sequences.values()):
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]]
        assert sum(n for _, n in parts) <= packing.CAPACITY
    assert len(sequences) <= -(-sum(r.length for r in got) // packing.CAPACITY) + 1


def test_assembled_sequences_hold_the_pieces(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    found = packing.tokenize(docs, packing.default_tokenizer())
    packed = packing.pack(found, found).collect()
    whole = {r.sequence_id: r.ids for r in packing.assemble(
        packing.pack(found, found)).collect()}
    for r in packed:
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == r.ids


def test_bins_are_filled_as_far_as_an_exhaustive_search_can():
    rng = random.Random(2)
    for _ in range(60):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(1, 60)
        chosen = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert all(0 < c <= counts[n] for n, c in chosen.items())
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * i for s in sums for i in range(c + 1)}
        assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= room)


@pytest.mark.parametrize("which", ["edge_dir", "sf"])
def test_near_duplicates(spark, request, which):
    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    got = QUERIES["op3_near_duplicates"](spark, folder).collect()
    want = brute.components(rows(folder))
    assert sorted((tuple(r)[:3] for r in got), key=key) == sorted(want, key=key)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_a_large_cluster_of_near_copies(spark, tmp_path, monkeypatch):
    """Many members that the hub does not join: the difference join, direct and nested."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for family in range(3):
        root = list(base)
        for i in rng.sample(range(150), 9):
            root[i] = f"f{family}x{i}"
        for _ in range(50):
            text = list(root)
            for i in rng.sample(range(150), rng.choice((1, 2, 3, 5))):
                text[i] = f"n{rng.randrange(10**9)}"
            texts.append(" ".join(text))
    data = list(enumerate(texts))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    want = sorted(brute.components(data))
    for direct in (64, 8):
        monkeypatch.setattr(near_dedup, "DIRECT", direct)
        got = near_dedup.near_duplicates(docs).collect()
        assert sorted(map(tuple, got)) == want


def test_difference_join_keeps_every_link(spark):
    """Links between members of a hub's group, against all pairs of their sets."""
    rng = random.Random(4)
    hub = frozenset(range(100))
    members = {}
    for i in range(1, 80):
        gone = set(rng.sample(sorted(hub), rng.choice((2, 6, 12, 20))))
        new = {1000 + rng.randrange(60) for _ in range(rng.choice((0, 3, 9)))}
        members[i] = (hub - gone) | new
    near = spark.createDataFrame(
        [(0, 0, len(hub), i, len(s), sorted(s ^ hub)) for i, s in members.items()],
        near_dedup.STAR)
    got = near_dedup._links_around_hubs(near, 85).collect()
    found = {frozenset(r) for r in got}
    sets = {0: hub, **members}
    want = {frozenset((a, b)) for a in sets for b in sets if a < b
            and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert found <= want
    joined = {x for p in want if 0 in p for x in p}   # these are in one component anyway
    assert {p for p in want if not p <= joined} <= found


@pytest.mark.parametrize("which", ["edge_dir", "sf"])
def test_personal_data(spark, request, which):
    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    got = QUERIES["op4_pii"](spark, folder).collect()
    want = []
    for i, t in rows(folder):
        base = brute.personal(t or "")
        kinds = [s.split(":")[0] for s in base.split(",")]
        want.append((i, *(kinds.count(k) for k in brute.KINDS), brute.sha(base)))
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    text = dict(rows(folder))
    for r in got:   # base spans stay
        assert set(brute.personal(text[r.doc_id] or "").split(",")) <= {*r.spans.split(","), ""}


def test_base_patterns_on_random_text():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@+-() 2:9%Zé\n") for _ in range(rng.randint(0, 40)))
        spans = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in pii.base_spans(text))
        assert spans == brute.personal(text)


def test_base_patterns_are_linear():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1 " * 60_000, "a@" * 100_000,
                 "1 " * 100_000, "a-" * 100_000 + "@", "(" * 100_000, "1:" * 100_000):
        pii._find(text)


def test_spans_found_by_supervision(spark):
    filler = "lorem ipsum dolor sit amet "
    texts = [filler + f"call +1 (946) 555-{i:04d} or mail bob.{i}@mail.example.com" for i in range(60)]
    texts += [filler + f"call (946) 555-{i:04d} today" for i in range(20)]
    texts += [filler + f"order 946-555-{i:04d} shipped" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.p_spans for r in pii.find_spans(docs).collect()}
    assert all(len(got[i]) == 2 for i in range(60))
    assert all([s.kind for s in got[i]] == ["phone"] and got[i][0].added for i in range(60, 80))
    assert all(not got[i] for i in range(80, 100))


def accepted(texts: list[str]) -> list[list[str]]:
    """The texts' added spans that the classifier takes."""
    found = [pii._find(t) for t in texts]
    counts = Counter(s["key"] for spans in found for s in spans)
    keys = set(pii.accepted_keys(dict(counts)))
    return [[t[s["start"]:s["end"]] for s in spans if s["added"] and s["key"] in keys]
            for t, spans in zip(texts, found, strict=True)]


def test_an_unreliable_objection_is_no_veto():
    """Phones beside 'order' and after 'Phone no.', where 'order' says little."""
    known = [f"call +1 (946) 555-{i:04d} today" for i in range(60)]
    known += [f"call about the order +1 (946) 555-{i:04d}" for i in range(60)]
    national = [f"call about the order (946) 555-{i:04d} now" for i in range(20)]
    national += [f"Phone no. (946) 555-{i:04d}" for i in range(20)]
    got = accepted(known + national)
    assert all(got[120 + i] == [f"(946) 555-{i % 20:04d}"] for i in range(40))


def test_a_number_that_fails_its_checksum_is_no_card():
    known = ["visa 4111 1111 1111 1111 now"] * 60
    got = accepted(known + ["visa 4111.1111.1111.1111 now"] * 10 + ["visa 4111.1111.1111.1112"] * 10)
    assert got[60:70] == [["4111.1111.1111.1111"]] * 10 and not any(got[70:])


def test_label_model_trusts_agreement():
    votes = np.array([[1, 1, 0], [1, 1, 1], [-1, -1, 0], [0, -1, -1]])
    q = pii.label_model(votes, np.array([50.0, 30, 40, 20]))
    assert q[:2].min() > 0.9 and q[2:].max() < 0.1


@pytest.mark.parametrize("which", ["edge_dir", "sf"])
def test_language_model(spark, request, which):
    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    got = sorted(map(tuple, QUERIES["op8_lm_score"](spark, folder).collect()), key=key)
    want = sorted(brute.base_scores(rows(folder)), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want])
    assert all(r[6] < 0 for r in got)
    if which == "sf":   # the model beats the base on what it was trained on
        assert sum(r[6] for r in got if not r[1]) > sum(r[5] for r in got if not r[1])


def test_language_model_learns_an_order(spark):
    texts = ["x a b c d e f g h " * 12, "x h g f e d c b a " * 12] * 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    from pyspark.sql import functions as F

    got = language_model.score_texts(docs, F.col("doc_id") % 10 == 0).filter("held_out").collect()
    assert all(r.score > 0.6 * r.base_score for r in got)


def test_probabilities_add_up_to_one():
    """Of the next token after a context: classes, then words, known and unseen."""
    context = np.arange(4)
    rng = np.random.default_rng(1)
    w = rng.normal(size=(language_model._FEATURES, language_model.ALL_CLASSES))
    p = np.exp(language_model.log_softmax(
        language_model.class_logits(w, np.zeros(language_model.ALL_CLASSES), context)))
    assert p.sum(axis=1) == pytest.approx(1)
    starts = np.array([0, 3, 4])
    within = np.exp(language_model._within(rng.normal(size=9), starts,
                                           lambda x: np.repeat(x, [3, 1, 5])))
    assert np.add.reduceat(within, starts) == pytest.approx(1)


@pytest.mark.parametrize("which", ["edge_dir", "sf"])
def test_search(spark, request, which):
    folder = SF_SMALL if which == "sf" else request.getfixturevalue(which)
    data = rows(folder)
    got = defaultdict(list)
    for r in QUERIES["op7_bm25_top_k"](spark, folder).collect():
        got[r.query_id].append((r["rank"], r.score, r.doc_id))
    single = {i: t for i, t in data if i is not None and i % 100 == 0}
    repeated = {i for i in single if sum(i == j for j, _ in data) > 1}
    asked = {i for i, t in single.items() if brute.words(t)}
    assert set(got) == asked
    for i in asked - repeated:
        want = brute.bm25(data, single[i], 10)
        hits = sorted(got[i])
        assert [s for _, s, _ in hits] == pytest.approx([s for s, _ in want])
        assert [r for r, _, _ in hits] == [*range(1, len(want) + 1)]


def test_search_over_many_shards(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"t{i}" for i in range(400)]
    data = [(i, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(400)],
                                     k=rng.choice((5, 40, 200))))) for i in range(600)]
    data += [(i + 1000, data[i][1]) for i in range(30)]   # ties
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    found = bm25.search(bm25.build_index(docs), docs.filter("doc_id % 50 = 0"), k=7).collect()
    got = defaultdict(list)
    for r in found:
        got[r.q_id].append((r["rank"], r.d_id, r.score))
    for i, t in data:
        if i % 50 == 0:
            want = brute.bm25(data, t, 7)
            assert [s for _, _, s in sorted(got[i])] == pytest.approx([s for s, _ in want])


def test_toxicity_on_edges(spark, edge_dir):
    got = QUERIES["op10_toxicity"](spark, edge_dir).collect()
    assert len(got) == len(rows(edge_dir))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == brute.remainder(r.doc_id, 3, 1) for r in got)


def test_toxicity_held_out(spark):
    rng = random.Random(6)
    neutral = [f"w{i}" for i in range(500)]
    data, labels = [], []
    for i in range(1500):
        text = rng.choices(neutral, k=60)
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(60)] = rng.choice(("nastya", "nastyo", "Vile!", "vile"))
        data.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, known)).filter("held_out").collect()
    right = sum((r.score >= 0.7) == (r.doc_id % 8 == 0) for r in got)
    assert right / len(got) > 0.98


def test_language_model_learns_rare_words(spark):
    """12,000 words, far beyond FREQUENT, each always followed by the same one."""
    from pyspark.sql import functions as F

    texts = [" ".join(f"a{j} b{j}" for j in range(i % 200, 6000, 200)) for i in range(1600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = language_model.score_texts(docs, F.col("doc_id") % 7 == 0).filter("held_out").collect()
    assert sum(r.score for r in got) > 0.5 * sum(r.base_score for r in got)


def test_language_model_gains_on_held_out_texts(spark):
    """Against the base, and against the class model without n-grams."""
    got = QUERIES["op8_lm_score"](spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)


@pytest.fixture(scope="module")
def random_texts(spark):
    """Some 150,000 tokens of 20,000 words, few n-grams of them found twice."""
    rng = np.random.default_rng(5)
    return spark.createDataFrame(
        [(i, " ".join(f"w{w}" for w in (rng.random(300) ** 3 * 20_000).astype(int)))
         for i in range(500)], "doc_id long, text string").coalesce(1).cache()


def test_language_model_scores_do_not_depend_on_blocks(spark, random_texts):
    """One block and bucket, or many, with n-grams of frequent words over all buckets."""
    from pyspark.sql import functions as F

    docs = random_texts.limit(60).unionByName(spark.createDataFrame(
        [(None, "w1 w2 w1"), (7, None), (7, "unseen words here"), (14, "the " * 900)],
        random_texts.schema))
    held_out = F.coalesce(F.col("doc_id") % 7 == 0, F.lit(False))
    got = [sorted(map(tuple, language_model.score_texts(
        docs, held_out, rounds=2, **size).collect()), key=key)
        for size in ({}, {"block": 2000, "bucket": 1000})]
    assert len(got[0]) == 64
    for one, other in zip(*got, strict=True):
        assert one[:5] == other[:5] and one[5:] == pytest.approx(other[5:])


def test_language_model_writes_little_for_a_token(spark, random_texts):
    """All tables it stores, with n-grams that seldom repeat (48.6 bytes a token before)."""
    from pyspark.sql import functions as F

    from ledgerline.session import input_bytes, shared_dir

    folder = shared_dir(spark, "runs", spark.sparkContext.applicationId)
    before = input_bytes(spark, folder)
    scored = language_model.score_texts(random_texts, F.col("doc_id") % 7 == 0, rounds=1)
    tokens = scored.agg(F.sum("n_tokens")).first()[0]
    written = input_bytes(spark, folder) - before
    assert tokens > 150_000 and written < 15 * tokens


def test_ngrams_of_a_block_are_asked_for_once(monkeypatch):
    """With sort keys too long for one number, too; words that training lacks are left out."""
    lm = language_model
    texts = [b"a b a b c", b"a b x", b"b a b c c a"]
    words = sorted({w for t in texts for w in t.split()} | {lm.END})
    block = lm.Block({
        "doc_id": [1, 2, 3], "held_out": [False, True, False],
        "size": [len(t.split()) + 1 for t in texts], "words": lm.pack_words(words),
        "tokens": lm.pack(np.array([words.index(w) for t in texts for w in [*t.split(), lm.END]]))})
    number = np.array([lm.UNSEEN if w == b"x" else 1 + i for i, w in enumerate(words)])
    want = {}
    for t, train in zip(texts, (1, 0, 1), strict=True):
        ids = [0, 0] + [int(number[words.index(w)]) for w in [*t.split(), lm.END]]
        for at in range(2, len(ids)):
            gram = (ids[at - 1] << 32 | ids[at - 2], ids[at])
            if lm.UNSEEN not in ids[at - 2:at]:
                want[gram] = want.get(gram, 0) + train
    for short in (lm.SHORT, 10):
        monkeypatch.setattr(lm, "SHORT", short)
        asked, placed = (lm.Grams(2, number, block, 3, 2, places=p) for p in (False, True))
        grams = list(zip(asked.context[asked.order].tolist(), asked.word[asked.order].tolist(),
                         strict=True))
        assert dict(zip(grams, asked.counts[asked.order].tolist(), strict=True)) == want
        assert len(grams) == len(want) == asked.bounds[-1]
        assert placed.keys.tolist() == asked.keys.tolist()


def test_packed_lists_come_back():
    for x in ([], [0], [255, 256, 0], [2 ** 63, 1, 2 ** 40]):
        assert language_model.unpack(language_model.pack(np.array(x, np.uint64))).tolist() == x
    for words in ([b""], [b"a", b"", b"bc"]):
        assert language_model.unpack_words(language_model.pack_words(words)) == words


def test_ngram_probabilities_add_up_to_one():
    """Over all words after a context: those seen after it and the others."""
    rng = np.random.default_rng(3)
    q = rng.dirichlet(np.ones(50))
    n = rng.poisson(0.4, (language_model.KINDS, 50))
    n[1] = 0   # a context that was not seen
    total, distinct = (np.repeat(x.sum(axis=1)[:, None], 50, axis=1) for x in (n, n > 0))
    p = language_model.interpolate(q, n, total, distinct, np.array([0.3, 0.5, 0.9]))
    assert p.sum() == pytest.approx(1) and p.min() > 0


def test_loose_matches_are_found_in_linear_time():
    """100,000 loose matches, and as many base spans between them."""
    import time

    text = " ".join(f"({200 + i % 700}) 555-{i % 10000:04d} a{i}@b.org" for i in range(30_000))
    begin = time.process_time()
    found = pii._find(text)
    assert len(found) == 60_000 and time.process_time() - begin < 20
    taken = [(s["start"], s["end"]) for s in found]
    assert all(a[1] <= b[0] for a, b in zip(taken, taken[1:], strict=False))


def test_free_spans():
    rng = random.Random(1)
    for _ in range(300):
        edges = sorted(rng.sample(range(60), 12))
        taken = [(edges[i], edges[i + 1]) for i in range(0, 6, 2)]
        found = sorted((s, s + rng.randint(1, 4)) for s in rng.sample(range(60), 8))
        assert pii._free(found, taken) == [
            (s, e) for s, e in found if not any(s < b and a < e for a, b in taken)]


def test_no_vote_is_no_span():
    silent = {"ip|0,0,0,0|0,0,0|loose": 500}
    assert pii.accepted_keys(silent) == []
    assert pii.accepted_keys({**silent, "ip|1,0,1,0|0,0,0|base": 500}) == ["ip|1,0,1,0|0,0,0|base"]
    spoken = {"phone|0,1,0,-1|2,1,1|loose": 1000, "phone|0,1,0,0|2,1,1|loose": 1000}
    assert pii.accepted_keys(spoken) == ["phone|0,1,0,0|2,1,1|loose"]


def test_planted_spans():
    """Precision and recall of the added spans over planted ones of every kind."""
    rng = random.Random(7)
    words = "the report of last week was late and nobody knew why it had been so".split()

    def card() -> str:
        digits = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
        digits += next(str(d) for d in range(10) if pii.luhn(digits + str(d)))
        return digits

    def groups(digits: str, mark: str) -> str:
        return mark.join(digits[i:i + 4] for i in range(0, 16, 4))

    true = {"email": lambda: f"write to ann{rng.randrange(999)} [at] mail [dot] org",
            "ip": lambda: "server " + ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(8)),
            "card": lambda: "visa " + groups(card(), "."),
            "phone": lambda: f"call ({rng.randrange(212, 900)}) {rng.randrange(220, 900)}-"
                             f"{rng.randrange(10 ** 4):04d}"}
    false = {"card": lambda: "lot " + groups("".join(str(rng.randrange(10)) for _ in range(16)), "_"),
             "phone": lambda: f"order 0{rng.randrange(10, 99)}-{rng.randrange(100, 199)}-"
                              f"{rng.randrange(10 ** 4):04d}"}
    base = {"email": lambda: f"mail bob{rng.randrange(999)}@post.example.com",
            "ip": lambda: f"server 10.1.{rng.randrange(256)}.{rng.randrange(256)}",
            "card": lambda: "visa " + groups(card(), " "),
            "phone": lambda: f"call +1 (946) 555-{rng.randrange(10 ** 4):04d}"}
    texts, planted = [], []
    for _ in range(900):
        kind, make = rng.choice([(k, f) for d in (true, false, base) for k, f in d.items()])
        source = next(n for n, d in (("true", true), ("false", false), ("base", base))
                      if d.get(kind) is make)
        texts.append(" ".join([*rng.choices(words, k=9), make(), *rng.choices(words, k=9)]))
        planted.append(source == "true")
    got = [bool(found) for found in accepted(texts)]
    hits = sum(g and p for g, p in zip(got, planted, strict=True))
    assert hits / sum(got) > 0.95 and hits / sum(planted) > 0.9


def test_shards_are_bounded_by_documents(spark):
    """Documents without terms, or with one, fill shards too; ties go to the smaller id."""
    docs = spark.range(40_000, numPartitions=1).selectExpr(
        "id AS doc_id", "CASE WHEN id % 4 = 0 THEN 'same words' WHEN id % 4 = 1 THEN '' "
                        "WHEN id % 4 = 2 THEN 'other' END AS text")
    index = bm25.build_index(docs)
    assert [r.docs for r in index.orderBy("shard").collect()] == [16384, 16384, 7232]
    found = bm25.search(index, docs.filter("doc_id = 39996 or doc_id = 1"), k=5).collect()
    assert sorted((r["rank"], r.q_id, r.d_id) for r in found) == [
        (i + 1, 39996, 4 * i) for i in range(5)]


def test_a_very_long_query(spark):
    """One query of 60,000 terms, beside documents that share a few of them."""
    long = " ".join(f"t{i}" for i in range(60_000))
    data = [(0, long)] + [(i, f"t{i} t{i + 1} x{i}") for i in range(1, 300)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = bm25.search(bm25.build_index(docs), docs.filter("doc_id = 0"), k=4).collect()
    want = brute.bm25(data, long, 4)
    assert [r.score for r in sorted(found, key=lambda r: r["rank"])] == pytest.approx(
        [s for s, _ in want])
