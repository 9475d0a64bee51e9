"""Alignment of two tokenizers: merge-path partitioning of their token ends.

Tokenizer A sees a space and the text, tokenizer B the text, which it puts a
space before; both cut the same bytes.  The ends of A's and of B's tokens are
two rising sequences.  Merging them is a path through a grid; diagonals at
equal distances cut the path into pieces of equal work, and a binary search on
each diagonal finds where (Odeh, Green, Mwassi, Shmueli and Birk, "Merge Path",
2012).  A piece looks at nothing but its own stretch of both sequences: it
emits the overlapping token pairs (one at each end) and the places where both
end.  A group that runs over a piece's border is stitched by counting the
common ends of the pieces before.  The documents of a block lie one behind the
other, so that short ones share a piece and a long one spreads over many.

Counts by pair of ids are gathered over the whole corpus: distinct pairs of a
block, then of a task, then by a shuffle.  A bounded table of the most frequent
pairs goes to every task; pairs beyond it are joined, so none is lost.

Defined cases: documents whose text is null or empty, or whose A or B bytes
differ from space and text, have no tokens; repeated rows are aligned and
counted each; an empty table gives an empty result; other columns are not
read; a text is encoded whole, however long it is, and memory follows the
longest text.  The word caches in the workers bound memory, never results.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, documents, per_worker

PIECE = 1 << 16            # steps of the merge in one piece
BLOCK_TOKENS = 1 << 20     # tokens of A and B aligned together
WORDS_CACHED = 350_000     # a cache only
PAIRS_HELD = 1 << 21       # distinct pairs that a task holds before it hands them on
KNOWN = 1 << 20            # most frequent pairs that every task looks up by itself

TOKENS = "row long, doc_id long, a binary, b binary"
PAIRS = "pair long, n long"
ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "n_best long, count_sum long, groups_sha256 string, rare array<long>")

# A space after anything but a space and before anything but white space: both
# tokenizers end a token before it, whatever stands around.
_CUT = re.compile(r"(?<=[^ ]) (?=[^\s\x1c-\x1f])")
_OTHER_SPACES = re.compile(r" (?:[\s\x1c-\x1f]|\Z)")


# --- tokens -----------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write it with: the
    printable ones stand for themselves, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """Byte-level tokenizer A: ids of a string, and every id's bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            if all(c in byte for c in piece):
                self.pieces[i] = bytes(byte[c] for c in piece)

    def encode(self, spaced: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([spaced], add_special_tokens=False)[0].ids


class PieceTokens:
    """Sentence-piece tokenizer B: ids of a string without its first space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
                       else b"" if self.model.is_control(i)
                       else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        # No piece goes on over a space, so words are encoded alike alone and in a row.
        self.by_word = all("▁" not in p.lstrip("▁") for p in names)

    def encode(self, spaced: str) -> list[int]:
        return self.model.encode(spaced[1:], num_threads=1)


class Pair:
    """Both tokenizers over texts cut at single spaces, with words known before."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = (ByteTokens(path_a), PieceTokens(path_b))
        self.lengths = tuple(np.array([len(p) for p in s.pieces], np.int64) for s in self.sides)
        self.kinds = tuple(np.dtype("<u2" if len(n) <= 1 << 16 else "<u4") for n in self.lengths)
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.broken: set[str] = set()

    def words(self, text: str) -> list[str]:
        """The text cut where both tokenizers cut, each part without its space."""
        if not self.sides[1].by_word:
            return [text]
        if text[0] != " " and not _OTHER_SPACES.search(text):
            return text.split(" ")
        return [w if i else w[1:] for i, w in enumerate(_CUT.split(" " + text))]

    def _together(self, side: int, words: list[str]) -> list[bytes] | None:
        """Ids of each word, all encoded in a row; None where ends do not meet."""
        coder, kind = self.sides[side], self.kinds[side]
        spaced = "".join(" " + w for w in words)
        ids = np.array(coder.encode(spaced), kind)
        if b"".join([coder.pieces[i] for i in ids.tolist()]) != spaced.encode():
            return None
        ends = np.cumsum(self.lengths[side][ids])
        marks = np.cumsum([len(w.encode()) + 1 for w in words])
        at = np.searchsorted(ends, marks)
        if (ends[at] != marks).any():
            return None
        raw, begin, size = ids.tobytes(), 0, kind.itemsize
        out = []
        for stop in (at + 1).tolist():
            out.append(raw[begin * size:stop * size])
            begin = stop
        return out

    def _learn(self, words: list[str]) -> None:
        # A word with a space at its end would run into the next one's space.
        rows = [w for w in words if not w.endswith(" ")]
        alone = [w for w in words if w.endswith(" ")]
        for side, known in enumerate(self.known):
            found = self._together(side, rows) if rows else []
            if found is not None:
                known.update(zip(rows, found, strict=True))
            for word in alone if found is not None else words:
                one = self._together(side, [word])
                if one is None:
                    self.broken.add(word)
                known[word] = one[0] if one else b""

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """(A's ids, B's ids) as bytes; both empty without a common cover."""
        if not text:
            return b"", b""
        words = self.words(text)
        a, b = self.known
        fresh = list(set(words).difference(a))
        full = len(a) >= WORDS_CACHED
        if fresh:
            self._learn(fresh)
        whole = not self.broken or self.broken.isdisjoint(words)
        out = ((b"".join(map(a.__getitem__, words)), b"".join(map(b.__getitem__, words)))
               if whole else (b"", b""))
        for word in fresh:
            if full or len(word) > 32 or "\n" in word:    # not kept
                del a[word], b[word]
                self.broken.discard(word)
        return out


def _encode(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = per_worker(f"pair {path_a} {path_b}", lambda: Pair(path_a, path_b))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [pair.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + len(found)), pa.int64()), batch.column(0),
                 pa.array([a for a, _ in found], pa.binary()),
                 pa.array([b for _, b in found], pa.binary())],
                names=["row", "doc_id", "a", "b"])
            row += len(found)
    return run


# --- merging ends --------------------------------------------------------------------


@dataclass
class Aligned:
    """One block: for each token of A the token of B at its end, and the other
    way round, where both end together, and the groups' numbers."""

    b_at: np.ndarray
    a_at: np.ndarray
    tied_a: np.ndarray
    tied_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of ``a`` and ``b`` crosses every ``piece``-th diagonal.

    Of equal ends A's comes first; a border between two equal ends moves past
    the second, so that no common end is torn apart.
    """
    n, m = len(a), len(b)
    d = np.append(np.arange(0, n + m, piece), n + m)
    lo, hi = np.maximum(0, d - m), np.minimum(d, n)
    while (lo < hi).any():
        mid = (lo + hi) // 2
        open_ = lo < hi
        at_a, at_b = np.where(open_, mid, 0), np.where(open_, d - 1 - mid, 0)
        first = a[at_a] <= b[at_b]
        lo, hi = np.where(open_ & first, mid + 1, lo), np.where(open_ & ~first, mid, hi)
    i, j = lo, d - lo
    torn = (i > 0) & (j < m)
    torn[torn] = a[i[torn] - 1] == b[j[torn]]
    return i, j + torn


def align(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Aligned:
    """Merge two sequences of rising ends that end alike, piece by piece."""
    n, m = len(a), len(b)
    out = Aligned(np.empty(n, np.int64), np.empty(m, np.int64), np.empty(n, bool),
                  np.empty(m, bool), np.empty(n, np.int64), np.empty(m, np.int64))
    if not n:
        return out
    i, j = diagonals(a, b, piece)
    cuts = np.zeros(len(i), np.int64)
    for p in range(len(i) - 1):        # independent of one another
        x, y = a[i[p]:i[p + 1]], b[j[p]:j[p + 1]]
        in_a, in_b = slice(i[p], i[p + 1]), slice(j[p], j[p + 1])
        at = np.searchsorted(y, x)
        out.b_at[in_a] = at + j[p]
        tied = np.zeros(len(x), bool)
        inside = at < len(y)
        tied[inside] = y[at[inside]] == x[inside]
        out.tied_a[in_a] = tied
        out.group_a[in_a] = np.cumsum(tied) - tied
        at = np.searchsorted(x, y)
        out.a_at[in_b] = at + i[p]
        tied = np.zeros(len(y), bool)
        inside = at < len(x)
        tied[inside] = x[at[inside]] == y[inside]
        out.tied_b[in_b] = tied
        out.group_b[in_b] = np.cumsum(tied) - tied
        cuts[p + 1] = int(tied.sum())
    before = np.cumsum(cuts)
    for p in range(len(i) - 1):        # stitched: groups go on over the border
        out.group_a[i[p]:i[p + 1]] += before[p]
        out.group_b[j[p]:j[p + 1]] += before[p]
    return out


@dataclass
class Block:
    """Documents one behind the other: ids, tokens a document, their alignment."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    aligned: Aligned

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Linked id pairs (A's id times ``width`` plus B's): at A's ends, and at
        those ends of B where A has none."""
        alone = ~self.aligned.tied_b
        return (self.a.astype(np.int64) * width + self.b[self.aligned.b_at],
                self.a[self.aligned.a_at[alone]].astype(np.int64) * width + self.b[alone])


def blocks(batch: pa.RecordBatch, lengths, kinds, piece: int) -> Iterator[tuple[int, int, Block]]:
    """(first row, last row, block) over the rows of a batch of tokens."""
    sizes = [len_.to_numpy(zero_copy_only=False).astype(np.int64) // kind.itemsize
             for len_, kind in ((pc.binary_length(batch.column(c)), k)
                                for c, k in zip(("a", "b"), kinds, strict=True))]
    work = sizes[0] + sizes[1]
    start, held = 0, 0
    for stop in range(1, batch.num_rows + 1):
        held += int(work[stop - 1])
        if held < BLOCK_TOKENS and stop < batch.num_rows:
            continue
        ids = [np.frombuffer(b"".join(batch.column(c).slice(start, stop - start).to_pylist()), k)
               for c, k in zip(("a", "b"), kinds, strict=True)]
        ends = [np.cumsum(n[x]) for n, x in zip(lengths, ids, strict=True)]
        yield start, stop, Block(*ids, sizes[0][start:stop], sizes[1][start:stop],
                                 align(*ends, piece))
        start, held = stop, 0


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sums of their counts."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def _count_pairs(lengths, kinds, piece: int, held_most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def hand_on():
            keys, counts = merge_counts(parts)
            for at in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at:at + (1 << 16)]), pa.array(counts[at:at + (1 << 16)])],
                    names=["pair", "n"])

        for batch in batches:
            for _, _, block in blocks(batch, lengths, kinds, piece):
                found = np.concatenate(block.pairs(len(lengths[1])))
                if not len(found):
                    continue
                parts.append(np.unique(found, return_counts=True))
                held += len(parts[-1][0])
                if held > held_most:
                    parts = [merge_counts(parts)]
                    held = len(parts[0][0])
                    if held > held_most // 2:
                        yield from hand_on()
                        parts, held = [], 0
        if parts:
            yield from hand_on()
    return run


# --- scores ---------------------------------------------------------------------------


def group_parts(block: Block, table: list[bytes]) -> list[bytes]:
    """Every document's groups as text: ids joined by commas, A's and B's apart
    by a bar, groups by semicolons.  ``table``: from :func:`digits`."""
    al, n, m = block.aligned, len(block.a), len(block.b)
    after_a = np.flatnonzero(al.tied_a) + 1       # tokens of A up to each group's end
    after_b = np.flatnonzero(al.tied_b) + 1
    place = np.empty(n + m, np.int64)
    place[np.arange(n) + np.append(0, after_b)[al.group_a]] = block.a * np.int64(2) + al.tied_a
    split = table_split(table)
    place[np.arange(m) + after_a[al.group_b]] = split + block.b * np.int64(2) + al.tied_b
    ends = np.cumsum(block.n_a + block.n_b).tolist()
    codes, out, begin = place.tolist(), [], 0
    for end in ends:
        out.append(b"".join([table[c] for c in codes[begin:end]])[:-1])
        begin = end
    return out


def digits(n_a: int, n_b: int) -> list[bytes]:
    """Text of an id with what follows it: within and at the end of A's part of
    a group, then the same for B's; the last entry says where B's begin."""
    rows = [str(i).encode() + sign for i in range(n_a) for sign in (b",", b"|")]
    rows += [str(i).encode() + sign for i in range(n_b) for sign in (b",", b";")]
    return [*rows, str(2 * n_a).encode()]


def table_split(table: list[bytes]) -> int:
    return int(table[-1])


def _by_document(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Exact sums of ``values`` between the documents' ends."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return np.diff(np.append(0, total[ends]))


def _score(lengths, kinds, piece: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, totals, best = shared.value
        width = len(lengths[1])
        table = per_worker(f"digits {len(lengths[0])} {width}",
                           lambda: digits(len(lengths[0]), width))
        for batch in batches:
            for start, stop, block in blocks(batch, lengths, kinds, piece):
                yield _scored(batch.slice(start, stop - start), block, keys, totals, best,
                              width, table)
    return run


def _scored(rows: pa.RecordBatch, block: Block, keys, totals, best, width, table):
    ends_a, ends_b = np.cumsum(block.n_a), np.cumsum(block.n_b)
    at_a, at_b = block.pairs(width)
    distinct, which = np.unique(np.concatenate([at_a, at_b]), return_inverse=True)
    at = np.searchsorted(keys, distinct)
    at[at == len(keys)] = 0
    known = keys[at] == distinct if len(keys) else np.zeros(len(distinct), bool)
    count = np.where(known, totals[at], 0) if len(keys) else np.zeros(len(distinct), np.int64)
    is_best = known & (count == best[distinct % width])
    # B's links stand where no end of A is; ends by document among those alone.
    alone_ends = np.append(0, np.cumsum(~block.aligned.tied_b))[ends_b]
    n = len(at_a)

    def summed(values: np.ndarray) -> np.ndarray:
        each = values[which]
        return _by_document(each[:n], ends_a) + _by_document(each[n:], alone_ends)

    if known.all():
        rare = pa.array([[]] * rows.num_rows, pa.list_(pa.int64()))
    else:
        unknown = ~known[which]
        parts = [distinct[which[:n]][unknown[:n]], distinct[which[n:]][unknown[n:]]]
        numbers = [np.append(0, np.cumsum(unknown[:n]))[ends_a].tolist(),
                   np.append(0, np.cumsum(unknown[n:]))[alone_ends].tolist()]
        begins, lists = (0, 0), []
        for stops in zip(*numbers, strict=True):
            lists.append(np.concatenate([p[lo:hi] for p, lo, hi in
                                         zip(parts, begins, stops, strict=True)]))
            begins = stops
        rare = pa.array(lists, pa.list_(pa.int64()))
    groups = _by_document(block.aligned.tied_b, ends_b)
    sha = [hashlib.sha256(g).hexdigest() if n_a else "" for g, n_a in
           zip(group_parts(block, table), block.n_a.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [rows.column("row"), rows.column("doc_id"), pa.array(block.n_a), pa.array(block.n_b),
         pa.array(groups), pa.array(block.n_a + block.n_b - groups),
         pa.array(summed(is_best)), pa.array(summed(count)), pa.array(sha), rare],
        names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
               "groups_sha256", "rare"])


def frequent(totals: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """Pairs frequent enough that at most ``most`` are, and whether that is all.

    The limit comes from a histogram of the counts (four bins an octave), which
    has a few hundred rows however many pairs there are.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 4)
    bins = sorted(((r["bin"], r["pairs"]) for r in totals.groupBy(step.alias("bin")).agg(
        F.count(F.lit(1)).alias("pairs")).collect()), reverse=True)
    taken, least = 0, None
    for at, pairs in bins:
        if taken + pairs > most:
            break
        taken, least = taken + pairs, at
    everything = taken == sum(p for _, p in bins)
    return totals.filter(step >= least if least is not None else F.lit(False)), everything


def align_documents(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id",
                    text: str = "text", known: int = KNOWN, piece: int = PIECE,
                    held: int = PAIRS_HELD) -> DataFrame:
    """One row a document: the contract's columns, ``groups_sha256`` last.

    Tokens are written once (two bytes each) and aligned twice, for the counts
    and for the scores: cheaper than writing every link.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    tokens = cut(given.mapInArrow(_encode(path_a, path_b), TOKENS), "tokens")
    pair = Pair(path_a, path_b)
    lengths, kinds, width = pair.lengths, pair.kinds, len(pair.lengths[1])
    counted = tokens.select("a", "b").mapInArrow(
        _count_pairs(lengths, kinds, piece, held), PAIRS)
    totals = cut(counted.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    # As many rows as B has ids.
    highest = cut(totals.groupBy((F.col("pair") % width).alias("best_b")).agg(
        F.max("n").alias("best_n")), "best")
    best = np.zeros(width, np.int64)
    for row in highest.collect():
        best[row["best_b"]] = row["best_n"]
    chosen, everything = frequent(totals, known)
    held_pairs = chosen.toArrow().sort_by("pair")      # at most `known` rows
    shared = spark.sparkContext.broadcast(
        (held_pairs.column("pair").to_numpy(), held_pairs.column("n").to_numpy(), best))
    scored = tokens.mapInArrow(_score(lengths, kinds, piece, shared), ALIGNED)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
               "groups_sha256"]
    if everything:
        return scored.select(*columns)
    # The pairs beyond the table: each is rare, so no key of this join is hot.
    scored = cut(scored, "scored")
    asked = scored.select("row", F.explode("rare").alias("asked")).groupBy("row", "asked").agg(
        F.count(F.lit(1)).alias("times"))
    flagged = totals.join(F.broadcast(highest), F.col("pair") % width == F.col("best_b")).select(
        "pair", "n", (F.col("n") == F.col("best_n")).cast("long").alias("is_best"))
    more = asked.join(flagged, F.col("asked") == F.col("pair")).groupBy(
        F.col("row").alias("more_row")).agg(
        F.sum(F.col("times") * F.col("is_best")).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return (scored.join(more, F.col("row") == F.col("more_row"), "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
            .select(*columns))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under a byte-level and a sentence-piece tokenizer."""
    import public_tokenizers

    return align_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
