"""Near-duplicate documents: circulant MinHash, banding, exact confirmation.

1. Each text becomes its set of hashed word shingles, a 128-bit hash of that
   set, and a circulant MinHash signature: one permutation places a shingle,
   the second, shifted by k, gives coordinate k, so all coordinates of a
   shingle are one slice of a table.  Four coordinates make a band.
2. Texts with equal sets are one class, a node of its own with a number; the
   links are between classes, so one id may stand on several texts.
3. Classes that share a band form a bucket.  No bucket is expanded
   into pairs: every member is compared with one hub, the member that sits in
   the largest buckets.  The comparison is exact, on whole shingle sets, and
   leaves the member's difference to the hub.  A text moves to the places where
   its class is hub or member, once each.
4. Two members that the hub does not join are compared by their differences:
   |x ^ y| follows from |Dx|, |Dy| and |Dx & Dy|.  A group of bounded size is
   dealt out to pairs of blocks, in which all common elements are counted.  In
   a larger one only members whose differences agree enough meet: links are
   found by a prefix filter over the rarest elements of the differences,
   exactly; two members meet once, at the smallest element they share.
   Elements that very many members share are treated like buckets, with a hub
   of their own.
5. Connected components over the confirmed links.

What can be missed is a pair that shares none of the bands: at a similarity
of 0.85 one in 140,000 (64 coordinates, 16 bands of 4), at 0.8 one in 300,000
with 24 bands.

Defined cases: null and empty texts have an empty set and are linked with
nothing; fewer words than a shingle count as one shingle; a null id is linked
with nothing; rows that repeat an id are judged row by row, each by its own
text (and equal rows alike); an empty table gives an empty result; other
columns are not read; a very long text is shingled whole, its signature in
chunks, and two such texts are compared as sorted sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import (
    WORD,
    any_row,
    boxed,
    cut,
    discard,
    documents,
    per_worker,
    rekeyed,
)
from ledgerline.llm.components import connected_components

PERMUTED = 22            # bits of the universe that the permutations act on
BANDS, ROWS = 16, 4
CHUNK = 8192             # shingles gathered at a time, bounds memory
WORDS_CACHED = 200_000   # a cache only: other words are hashed each time
#: Members without a link to the hub, up to which an element's members are
#: compared directly; beyond, the element's members get a hub of their own.
DIRECT = 64
#: Members of a hub, about, that are compared with it in one place.
TOGETHER = 64
#: Members and elements of differences, up to which a hub's group is compared in
#: pairs of blocks, and those that a block has as long as BLOCKS are enough.
GROUP, GROUP_ELEMENTS = 1 << 14, 1 << 23
BLOCK, BLOCK_ELEMENTS, BLOCKS = 128, 1 << 16, 16

_M = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                  0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
_33 = np.uint64(33)


class WordHashes(dict):
    """64-bit hash of a word (bytes), kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < WORDS_CACHED and len(word) <= 64:
            self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (murmur finaliser)."""
    x = (x ^ (x >> _33)) * _M[3]
    x = (x ^ (x >> _33)) * _M[4]
    return x ^ (x >> _33)


def shingle_set(text: bytes | None, hashes: WordHashes, size: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    ``bytes.lower`` folds A-Z alone and ``bytes.split`` cuts at ASCII white
    space alone, which is the definition of a word here.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    take = min(size, len(h))
    x = np.full(len(h) - take + 1, take, np.uint64)
    for i in range(take):
        x = mixed(x * _M[0] + h[i:len(h) - take + 1 + i] * _M[1] + _M[2])
    x.sort()
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


class Signer:
    """Circulant MinHash signatures, as one 64-bit key per band."""

    def __init__(self, n_bands: int = BANDS, seed: int = 7):
        rng = np.random.default_rng(seed)
        universe, k = 1 << PERMUTED, n_bands * ROWS
        self.n_bands = n_bands
        self.place = rng.permutation(universe).astype(np.uint32)
        shifted = rng.permutation(universe).astype(np.uint32)
        table = np.concatenate((shifted, shifted[:k]))
        self.windows = np.lib.stride_tricks.sliding_window_view(table, k)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        at = self.place[(shingles >> np.uint64(64 - PERMUTED)).astype(np.int64)]
        parts = [self.windows[at[i:i + CHUNK]].min(axis=0) for i in range(0, len(at), CHUNK)]
        return parts[0] if len(parts) == 1 else np.minimum.reduce(parts)

    def bands(self, signatures: np.ndarray) -> np.ndarray:
        rows = signatures.reshape(-1, self.n_bands, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, self.n_bands + 1, dtype=np.uint64), rows.shape[:2])
        for r in range(ROWS):
            key = mixed(key * _M[0] + rows[:, :, r] * _M[1] + _M[2])
        return key


SKETCH = "d_id long, d_h long, d_n long, d_k1 long, d_k2 long, d_bands array<long>"


def _sketch(size: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("word hashes", WordHashes)
        signer = per_worker(f"signer {bands}", lambda: Signer(bands))
        for batch in batches:
            n, keys, signatures = [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py(), hashes, size)
                n.append(len(s))
                if len(s):
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                    signatures.append(signer.signature(s))
            n = np.array(n, np.int64)
            full = n > 0
            k = np.zeros((len(n), 2), np.int64)
            values = np.empty(0, np.int64)
            if keys:
                k[full] = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                values = signer.bands(np.stack(signatures)).reshape(-1).view(np.int64)
            offsets = np.concatenate(([0], np.cumsum(full * bands))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(k[:, 0], mask=~full),
                 pa.array(k[:, 1], mask=~full),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                names=["d_id", "d_h", "d_n", "d_k1", "d_k2", "d_bands"])
    return run


STAR = "g long, p long, p_n long, rep long, n long, delta array<long>"


def _compare(size: int):
    """(p, part, member, rep, text), a part's hub before its members -> sizes and the
    symmetric difference of the sets of hub and member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("word hashes", WordHashes)
        hub = np.empty(0, np.uint64)
        for batch in batches:
            p, rep, p_n, n, deltas = [], [], [], [], []
            for a, member, b, text in zip(*(batch.column(i) for i in (0, 2, 3, 4)), strict=True):
                s = shingle_set(text.as_py(), hashes, size)
                if not member.as_py():
                    hub = s
                    continue
                p.append(a.as_py())
                rep.append(b.as_py())
                p_n.append(len(hub))
                n.append(len(s))
                deltas.append(np.setxor1d(hub, s, assume_unique=True))
            offsets = np.concatenate(([0], np.cumsum([len(d) for d in deltas]))).astype(np.int32)
            values = np.concatenate(deltas) if deltas else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int64()), pa.array(p, pa.int64()), pa.array(p_n, pa.int64()),
                 pa.array(rep, pa.int64()), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets),
                                          pa.array(values.view(np.int64)))],
                names=["g", "p", "p_n", "rep", "n", "delta"])
    return run


def linked(difference, total, percent: int):
    """Whether sets of ``total`` elements together, differing in ``difference``,
    have 100 * intersection >= percent * union."""
    return (100 + percent) * difference <= (100 - percent) * total


def _hub_pairs(classes: DataFrame) -> DataFrame:
    """(p, rep) pairs of a hub and a member."""
    rows = classes.select("rep", F.explode("bands").alias("bucket"))
    many = (rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
            .select(rekeyed("bucket").alias("kb"), F.col("bucket").alias("b"), "m"))
    rows = cut(rows.withColumn("kb", rekeyed("bucket")).join(many, "kb")
               .filter("bucket = b").select("bucket", "rep", "m"), "buckets")
    weight = rows.groupBy("rep").agg(F.sum("m").alias("w")).select(
        rekeyed("rep").alias("kr"), F.col("rep").alias("r"), "w")
    weighed = rows.withColumn("kr", rekeyed("rep")).join(weight, "kr").filter("rep = r")
    hubs = weighed.groupBy("bucket").agg(
        F.max_by("rep", F.struct("w", -F.col("rep"))).alias("p"))
    hubs = cut(hubs, "hubs")
    pairs = cut(rows.join(hubs, "bucket").filter("rep <> p").select("p", "rep").distinct(),
                "pairs")
    discard(rows, hubs)
    return pairs


def _places(pairs: DataFrame) -> DataFrame:
    """(rep, places): the places (p, part, member) where the text of ``rep`` is wanted.

    A hub's members are dealt out to parts, to each of which its text goes as well.
    """
    parts = pairs.groupBy("p").agg(
        F.ceil(F.count(F.lit(1)) / TOGETHER).cast("int").alias("parts"))
    hubs = parts.select(F.col("p").alias("rep"), "p", F.explode(F.sequence(
        F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"))
    parts = parts.select(rekeyed("p").alias("kp"), F.col("p").alias("pp"), "parts")
    members = pairs.withColumn("kp", rekeyed("p")).join(parts, "kp").filter("p = pp").select(
        "rep", "p", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part"),
        F.lit(True).alias("member"))
    return members.unionByName(hubs).groupBy("rep").agg(
        F.collect_list(F.struct("p", "part", "member")).alias("places"))


def _prefixes(near: DataFrame, percent: int) -> DataFrame:
    """(g, e, rep, n, joined, size): each member's rarest difference elements,
    as many as a pair that needs them must share one of.

    Let t be the difference a link allows for each element of both sets.  A
    member x shares with a linked y at least |Dx| - t(nx + ny) elements, and,
    as one of both is not joined to the hub, at least half of
    |Dx| + t(np - nx) if x is; always one.
    """
    a, b = 100 - percent, 100 + percent
    size, n, p_n = F.size("delta").cast("long"), F.col("n"), F.col("p_n")
    share = F.greatest(
        F.lit(1).cast("long"), size - F.floor(a * n / percent),
        F.when(F.col("joined"),
               F.floor((b * size + a * (p_n - n)) / (2 * b)) + 1).otherwise(1)).cast("long")
    members = near.withColumns({"size": size, "upto": (size - share + 1).cast("int")})
    elements = members.select("g", "rep", F.explode("delta").alias("e"))
    df = elements.groupBy("g", "e").agg(F.count(F.lit(1)).alias("df")).select(
        rekeyed("g", "e").alias("ke"), F.col("g").alias("fg"), F.col("e").alias("fe"), "df")
    ranked = (elements.withColumn("ke", rekeyed("g", "e")).join(df, "ke")
              .filter("g = fg and e = fe").groupBy("g", "rep")
              .agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("order")))
    out = members.select("g", "rep", "n", "joined", "size", "upto").join(ranked, ["g", "rep"])
    return out.filter("upto > 0").select(
        "g", F.explode(F.slice("order", 1, F.col("upto"))).alias("o"), "rep", "n", "joined",
        "size").filter("o.df > 1").select("g", F.col("o.e").alias("e"), "rep", "n", "joined",
                                          "size")


def _close(few: DataFrame, percent: int) -> DataFrame:
    """(g, x_rep, y_rep): members of a group that share an element, x not joined to
    the hub, whose sizes allow a link.

    Two members often share several elements; they meet at the smallest of them
    alone, so a pair is one row however much its members agree.
    """
    members = cut(few.groupBy("g", "rep").agg(
        F.sort_array(F.collect_list("e")).alias("es"),
        *(F.first(c).alias(c) for c in ("n", "joined", "size"))), "few")
    x = members.filter("not joined").select(
        "g", F.explode("es").alias("e"),
        *(F.col(c).alias(f"x_{c}") for c in ("rep", "n", "size", "es")))
    y = members.select("g", F.explode("es").alias("e"), *(
        F.col(c).alias(f"y_{c}") for c in ("rep", "n", "size", "joined", "es")))
    total = F.col("x_n") + F.col("y_n")
    return (x.join(y, ["g", "e"]).filter("y_joined or x_rep < y_rep").filter("x_rep <> y_rep")
            .filter(linked(F.abs(F.col("x_size") - F.col("y_size")), total, percent))
            .filter(linked(F.abs(F.col("x_n") - F.col("y_n")), total, percent))
            .filter(F.array_min(F.array_intersect("x_es", "y_es")) == F.col("e"))
            .select("g", "x_rep", "y_rep"))


def _runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Successive rows that agree in the first ``n_keys`` columns, all numbers."""
    held, last = [], None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False)
                         for i in range(n_keys)], 1)
        ends = [*np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
        for a, b in pairwise([0, *ends]):
            if a == b:
                continue
            key = tuple(keys[a])
            if held and key != last:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield held


def _within(rows: list[pa.RecordBatch], percent: int) -> tuple[list[int], list[int]]:
    """(u, v): links of the members of two blocks, or of one, that the hub does not
    join, to the others.

    Of a member with more than DIRECT links one to each set of members that
    earlier links join is enough.
    """
    def column(name: str) -> np.ndarray:
        return np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in rows])

    joined = column("joined")
    if len(joined) < 2 or joined.all():
        return [], []
    rep, n, block = column("rep"), column("n"), column("block")
    sizes = np.concatenate([pc.list_value_length(b.column("delta")).to_numpy() for b in rows])
    sizes = sizes.astype(np.int64)
    values = np.concatenate([b.column("delta").flatten().to_numpy() for b in rows])
    _, element, df = np.unique(values, return_inverse=True, return_counts=True)
    holder = np.repeat(np.arange(len(rep)), sizes)[np.argsort(element, kind="stable")]
    first, ends = np.cumsum(df) - df, np.cumsum(sizes)
    apart = (block != block[0]).any()   # two blocks: members of one meet elsewhere
    label = np.where(joined, -1, np.arange(len(rep)))
    u, v = [], []
    for x in np.flatnonzero(~joined):
        own = element[ends[x] - sizes[x]:ends[x]]
        own = own[df[own] > 1]
        count = df[own]
        at = np.repeat(first[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        common = np.bincount(holder[at], minlength=len(rep))
        found = linked(sizes[x] + sizes - 2 * common, n[x] + n, percent)
        found &= block != block[x] if apart else np.arange(len(rep)) != x
        found = np.flatnonzero(found & (joined | (np.arange(len(rep)) > x)))
        if len(found) > DIRECT:
            kinds, one = np.unique(label[found], return_index=True)
            found = found[one[kinds != label[x]]]
        u += [int(rep[x])] * len(found)
        v += rep[found].tolist()
        if len(found):
            label[np.isin(label, label[found])] = label[x]
    return u, v


def _in_blocks(percent: int):
    """(g, lo, hi, ...) rows in the order of these -> links, see :func:`_within`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        for rows in _runs(batches, 3):
            for all_, more in zip((u, v), _within(rows, percent), strict=True):
                all_ += more
            if len(u) > 1 << 16:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
                u, v = [], []
        yield pa.RecordBatch.from_arrays(
            [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
    return run


def _links_in_blocks(near: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(u, v) links of members that their hub does not join, in ``groups`` (ag, m,
    elements): each block of a group's members meets each other block and itself."""
    sized = groups.select("ag", F.least(F.lit(BLOCKS), F.ceil(F.greatest(
        F.col("m") / BLOCK, F.col("elements") / BLOCK_ELEMENTS, F.lit(1.0)))).cast("int")
        .alias("blocks"))
    members = near.join(sized, near["g"] == sized["ag"]).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    units = members.select("g", "rep", "n", "joined", "block", "delta", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "g", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "rep", "n", "joined", "block", "delta")
    return units.repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi").mapInArrow(
        _in_blocks(percent), "u long, v long")


def _links_around_hubs(near: DataFrame, percent: int) -> DataFrame:
    """(u, v) links between members of a group that its hub does not join."""
    found = None
    while True:
        near = near.withColumn("joined", linked(F.size("delta"), F.col("n") + F.col("p_n"),
                                                percent))
        direct = near.filter("joined").select(F.col("p").alias("u"), F.col("rep").alias("v"))
        found = direct if found is None else found.unionByName(direct)
        groups = cut(near.groupBy("g").agg(
            F.count(F.lit(1)).alias("m"), F.sum(F.size("delta").cast("long")).alias("elements"),
            F.count(F.when(~F.col("joined"), 1)).alias("apart"))
            .filter("m > 1 and apart > 0").select(F.col("g").alias("ag"), "m", "elements"), "apart")
        bounded = (F.col("m") <= GROUP) & (F.col("elements") <= GROUP_ELEMENTS)
        found = cut(found.unionByName(_links_in_blocks(near, groups.filter(bounded), percent)),
                    "links")
        apart = groups.filter(~bounded)
        if not any_row(apart):
            return found
        near = near.join(apart, near["g"] == apart["ag"], "left_semi")
        posts = cut(_prefixes(near, percent), "posts")
        heads = cut(posts.groupBy("g", "e").agg(
            F.count(F.lit(1)).alias("m"), F.count(F.when(~F.col("joined"), 1)).alias("apart"),
            F.min_by("rep", F.struct("joined", "size", "rep")).alias("hub"))
            .filter("m > 1 and apart > 0")
            .select(F.col("g").alias("hg"), F.col("e").alias("he"), "apart", "hub"), "heads")
        same = (posts["g"] == heads["hg"]) & (posts["e"] == heads["he"])
        shared = cut(posts.join(heads, same).drop("hg", "he"), "shared")
        discard(posts, heads)

        # Few apart: compare each of them with the element's members.
        pairs = _close(shared.filter(F.col("apart") <= DIRECT), percent)
        d = near.select("g", "rep", "n", "delta")
        dx = d.select("g", F.col("rep").alias("x_rep"), F.col("n").alias("x_n"),
                      F.col("delta").alias("x_d"))
        dy = d.select("g", F.col("rep").alias("y_rep"), F.col("n").alias("y_n"),
                      F.col("delta").alias("y_d"))
        apart_by = (F.size("x_d") + F.size("y_d")
                    - 2 * F.size(F.array_intersect("x_d", "y_d")))
        total = F.col("x_n") + F.col("y_n")
        more = (cut(pairs, "close").join(dx, ["g", "x_rep"]).join(dy, ["g", "y_rep"])
                .filter(linked(apart_by, total, percent))
                .select(F.col("x_rep").alias("u"), F.col("y_rep").alias("v")))
        before, found = found, cut(found.unionByName(more), "links")
        discard(before)

        # Many apart: the element's members get the least different of them as
        # hub; elements of one family mostly agree on it and make one group.
        many = shared.filter(F.col("apart") > DIRECT)
        if not any_row(many):
            return found
        hub = d.select(F.col("g").alias("hg"), F.col("rep").alias("hr"),
                       F.col("n").alias("h_n"), F.col("delta").alias("h_d"))
        inner = (many.select("g", "rep", "hub").filter("rep <> hub").distinct()
                 .join(d, ["g", "rep"])
                 .join(hub, (F.col("g") == F.col("hg")) & (F.col("hub") == F.col("hr"))))
        near = cut(inner.select(
            F.xxhash64("g", "hub").alias("g"), F.col("hub").alias("p"), F.col("h_n").alias("p_n"),
            "rep", "n",
            F.concat(F.array_except("delta", "h_d"),
                     F.array_except("h_d", "delta")).alias("delta")), "inner")
        discard(shared)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = 85, shingle: int = 3, bands: int = BANDS) -> DataFrame:
    """One row per row of ``docs``: d_id, d_n (shingles) and d_component (the
    smallest id that is reachable over links; null for a null id)."""
    return _grouped(docs, doc_id, text, percent, shingle, bands).select(
        "d_id", "d_n", "d_component")


def _grouped(docs: DataFrame, doc_id: str, text: str, percent: int, shingle: int,
             bands: int) -> DataFrame:
    """:func:`near_duplicates` with d_h, the text's xxhash64, and d_group, a number
    of the component (null without an id or words)."""
    given = docs.select(F.col(doc_id).cast("long").alias("d_id"),
                        F.xxhash64(F.col(text)).alias("d_h"),
                        F.col(text).cast("binary").alias("d_text"))
    sketches = cut(given.mapInArrow(_sketch(shingle, bands), SKETCH), "sketches")
    # A class is known by a number; its text is that of its smallest (id, text) row.
    # Numbers rise with these rows: among equals the hub is the one with the
    # smallest id, which in a family of near copies is often their original.
    collapsed = sketches.filter("d_n > 0 and d_id is not null").groupBy("d_k1", "d_k2").agg(
        F.min(F.struct("d_id", "d_h")).alias("row"), F.first("d_bands").alias("bands"))
    classes = cut(collapsed.repartitionByRange("row").sortWithinPartitions("row").withColumn(
        "rep", F.monotonically_increasing_id()), "classes")
    pairs = _hub_pairs(classes)
    wanted = classes.join(_places(pairs), "rep").select(
        "rep", "places", F.col("row.d_id").alias("w_id"), F.col("row.d_h").alias("w_h"))
    # A merge join at every size: the classes grow with the documents.
    texts = cut(given.join(wanted.hint("merge"), (F.col("d_id") == F.col("w_id"))
                           & (F.col("d_h") == F.col("w_h"))).select("rep", "places", "d_text"),
                "texts")
    discard(pairs)
    if any_row(texts.groupBy("rep").count().filter("count > 1")):   # repeated rows
        rows, texts = texts, cut(texts.groupBy("rep").agg(
            F.first("places").alias("places"), F.first("d_text").alias("d_text")), "single")
        discard(rows)
    placed = texts.select("rep", F.explode("places").alias("at"), "d_text").select(
        "at.p", "at.part", "at.member", "rep", "d_text")
    near = cut(placed.repartition("p", "part").sortWithinPartitions("p", "part", "member")
               .mapInArrow(_compare(shingle), STAR), "near")
    discard(texts)
    links = _links_around_hubs(near, percent)
    discard(near)
    # Numbers rise with the ids, so a component's smallest class has its smallest
    # id.  Most classes stand alone.
    numbered = classes.select("rep", F.col("row.d_id").alias("least"))
    linked_to = connected_components(links).join(
        numbered.withColumnsRenamed({"rep": "c_rep", "least": "c_least"}),
        F.col("component") == F.col("c_rep")).select("node", "component", "c_least")
    of_class = cut(classes.join(linked_to, F.col("rep") == F.col("node"), "left").select(
        F.col("d_k1").alias("k1"), F.col("d_k2").alias("k2"),
        F.coalesce("component", "rep").alias("group"),
        F.coalesce("c_least", "row.d_id").alias("component")), "components")
    discard(classes, links)
    same = (F.col("d_k1") == F.col("k1")) & (F.col("d_k2") == F.col("k2"))
    known = F.col("d_id").isNotNull()
    return sketches.join(of_class, same, "left").select(
        "d_id", "d_h", "d_n",
        F.when(known, F.coalesce("component", "d_id")).alias("d_component"),
        F.when(known, F.col("group")).alias("d_group"))


#: Stands for a null id where rows without one take part.
NO_ID = (1 << 63) - 1


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80,
                shingle: int = 5, bands: int = 24) -> DataFrame:
    """``docs`` with one row of each component, and every row without words.

    The row with the smallest id stays (null last), of several with that id the
    one with the smallest hash of its text, of rows that agree in both the
    smallest in the order of their columns.  Which texts stay depends on the
    texts alone: an id that stands on several is no link between them.
    """
    rows = docs.select(
        boxed(docs), F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID)).alias("i_"),
        docs[text].alias("t_"), F.coalesce(docs[text].rlike(WORD), F.lit(False)).alias("w_"))
    found = cut(_grouped(rows.select("i_", "t_"), "i_", "t_", percent, shingle, bands), "found")
    keys = cut(found.filter("d_group is not null").groupBy("d_group").agg(
        F.min(F.struct("d_id", "d_h")).alias("k")).select(
        F.col("k.d_id").alias("k_id"), F.col("k.d_h").alias("k_h")), "kept")
    single = rows.filter("w_").select("row", "i_", F.xxhash64("t_").alias("h_"))
    if any_row(found.filter("d_group is not null").groupBy("d_id", "d_h").count().filter(
            "count > 1")):
        # Rows that repeat an id and a text collapse before they move.
        single = single.groupBy("i_", "h_").agg(F.min("row").alias("row"))
    # A merge join at every size: the components grow with the documents.
    kept = single.join(keys.hint("merge"), (F.col("i_") == F.col("k_id"))
                       & (F.col("h_") == F.col("k_h")), "left_semi")
    return kept.select("row.*").unionByName(rows.filter("not w_").select("row.*"))


def op3_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Every document with its group of near-duplicates."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(
        F.col("d_id").alias("doc_id"), F.col("d_n").alias("n_shingles"),
        F.col("d_component").alias("component_id"),
        F.coalesce(F.col("d_id") == F.col("d_component"), F.lit(True)).alias("kept"))
