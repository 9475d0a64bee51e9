"""Best-fit packing of token sequences: minimum bin slack over lengths.

Documents are tokenised and cut only where they exceed the capacity.  What
the packing needs of the corpus is one count per length, at most as many as
the capacity, however many documents there are.  On these counts, bin after
bin is filled: a subset-sum bitset over the lengths left finds the fullest
feasible combination that holds the longest one, and the combination is
removed as often as the counts allow.  Every piece then finds its place by
its rank among the pieces of its length, which is a count within its
partition plus the counts of the partitions before: no sort, and no task that
sees all pieces of a frequent length.

Defined cases: null and empty texts are one piece of the end token; repeated
rows are packed each; an empty table gives an empty result; other columns are
not read; a word of any length is tokenised whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, documents, per_worker

CAPACITY = 4096
END_ID = 1
WORDS_CACHED = 800_000   # a cache only: some 150 MB at most
_RANK_BITS = 40

#: A pre-tokenizer's first step that parts letters from signs, and the normalizers before it.
SPLIT = {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {
    "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}}
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Texts that these leave as they are, and Latin, Greek and Cyrillic letters that they turn
#: into letters alone.  Others may not be: dotted capital I ends in a combining mark, which
#: the pattern takes together with a sign behind it.
NORMALIZED = re.compile("[a-z \u00df-\u00f6\u00f8-\u00ff]*")
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
                     "\u0388-\u038a\u038e-\u03a1\u03a3-\u03ce\u0400-\u0481]+")
#: ASCII signs without the apostrophe, which the pattern may take with letters.
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

PIECES = ("doc_id long, piece int, start long, length int, ids binary, "
          "part int, place long")


class WordTokens:
    """Ids of words (bytes) as little-endian 32-bit bytes, kept for words seen
    before.

    The tokenizer drops white space before it looks at anything else, so a
    text's ids are those of its words in a row.  Unseen words are encoded
    together, with a special token between them that marks the ends.

    Where the tokenizer's own pattern parts letters from signs (:data:`SPLIT`),
    a word of letters with signs around it is the signs, the letters and the
    signs in a row.  Letters, in lower case, are then encoded once, with spaces
    between them: each is one run of the pattern, whose last token alone has
    the suffix that ends a run.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.known: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        marks = [(i, t.content) for i, t in added.items()
                 if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark_id, self.mark = max(marks, default=(None, None))
        # Without normalizers, for texts that these leave as they are.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = self.tokenizer.pre_tokenizer
        self.added = [t.content.encode() for t in added.values()]
        self.has_added = re.compile(b"|".join(map(re.escape, self.added)) or b"(?!)").search
        self.ends = self._run_ends(path)

    def _run_ends(self, path: str) -> np.ndarray | None:
        """For each id, whether it ends a run; None if words are not to be parted."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"].get("end_of_word_suffix")
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        if (not suffix or split != SPLIT or [s["type"] for s in steps] != NORMALIZERS
                or any(t.decode().isalpha() for t in self.added)):
            return None
        ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        ends[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True
        return ends

    def _encode(self, text: str, normalized: bool = False) -> np.ndarray:
        # The fast call gives the same ids and keeps no offsets.
        return np.array((self.bare if normalized else self.tokenizer).encode_batch_fast(
            [text], add_special_tokens=False)[0].ids, "<u4")

    def _marked(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        texts = [(w, w.decode()) for w in words]
        together = [(w, t) for w, t in texts if self.mark and self.mark not in t]
        out = {w: self._encode(t).tobytes() for w, t in texts
               if not self.mark or self.mark in t}
        if together:
            ids = self._encode(self.mark.join(t for _, t in together))
            ends = [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
            raw, at = ids.tobytes(), 0
            for (w, _), end in zip(together, ends, strict=True):
                out[w] = raw[4 * at:4 * end]
                at = end + 1
        return out

    def _letters(self, words: list[bytes]) -> dict[bytes, bytes]:
        text = b" ".join(words).decode()
        ids = self._encode(text, NORMALIZED.fullmatch(text) is not None)
        ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
        # Every word has at least one run, so as many ends as words: one each.
        if len(ends) != len(words):
            return self._marked(words)
        raw, stops = ids.tobytes(), ends.tolist()
        return {w: raw[at:to] for w, at, to in zip(words, [0, *stops], stops, strict=False)}

    def encode(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of ``words``, and of the letters and signs they were parted into."""
        if self.ends is None:
            return self._marked(words)
        known, parted, rest, letters = self.known, [], set(), set()
        for w in words:
            stem = w.strip(SIGNS)
            if not (stem.isalpha() or stem.decode().isalpha()):
                rest.add(w)
            elif len(stem) == len(w):
                low = w.lower()
                letters.add(low)
                if low != w:
                    parted.append((w, b"", low, b""))
            elif self.has_added(w) or not (stem.isalpha() or LETTERS.fullmatch(stem.decode())):
                rest.add(w)
            else:
                low, at = stem.lower(), w.index(stem)
                parted.append((w, w[:at], low, w[at + len(stem):]))
                letters.add(low)
                rest.update((w[:at], w[at + len(stem):]))
        rest.discard(b"")
        out = self._marked(rest.difference(known))
        if letters := letters.difference(known):
            out.update(self._letters(list(letters)))
        out[b""] = b""
        for w, *parts in parted:
            out[w] = b"".join([out[p] if p in out else known[p] for p in parts])
        del out[b""]
        return out

    def ids(self, text: bytes | None) -> bytes:
        words, known = (text or b"").split(), self.known
        ids = list(map(known.get, words))
        unseen = [i for i, found in enumerate(ids) if found is None]
        if unseen:
            fresh = self.encode({words[i] for i in unseen})
            for i in unseen:
                ids[i] = fresh[words[i]]
            if len(known) < WORDS_CACHED:
                known.update((w, t) for w, t in fresh.items() if len(w) <= 64)
        return b"".join(ids)


def _tokenize(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_worker(f"tokens {path}", lambda: WordTokens(path))
        end = np.array([end_id], "<u4").tobytes()
        part, seen, step = TaskContext.get().partitionId(), [0] * (capacity + 1), 4 * capacity
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens.ids(text.as_py()) + end
                for i, at in enumerate(range(0, len(ids), step)):
                    piece = ids[at:at + step]
                    n = len(piece) // 4
                    for column, value in zip(rows, (doc_id, i, at // 4, n, piece, seen[n]),
                                             strict=True):
                        column.append(value)
                    seen[n] += 1
            d, i, s, n, ids, place = rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(i, pa.int32()), pa.array(s, pa.int64()),
                 pa.array(n, pa.int32()), pa.array(ids, pa.binary()),
                 pa.array([part] * len(d), pa.int32()), pa.array(place, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids", "part", "place"])
    return run


def tokenize(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
             capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, written once: doc_id, piece,
    start, length, ids (little-endian 32-bit), and the piece's partition and
    place among the pieces of its length there.

    ``tokenizer``: path of a tokenizer file, the same on every executor, that
    drops white space.
    """
    given = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    return cut(given.mapInArrow(_tokenize(tokenizer, capacity, end_id), PIECES), "pieces")


@dataclass
class Plan:
    """Runs of equal-length pieces and where they go: the ``j``-th piece of a
    run is in sequence ``first + j // times`` at ``offset + j % times * length``."""

    key: np.ndarray      # length << 40 | rank of the run's first piece, ascending
    first: np.ndarray
    times: np.ndarray
    offset: np.ndarray
    sequences: int


def fullest(counts: Mapping[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``.

    ``lengths`` descending.  Bit s of ``reach`` says that sum s is feasible; a
    length available m times enters as 1, 2, 4, ... copies, so every
    multiplicity up to m can be made.
    """
    reach, mask, taken = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        if length > room:
            continue
        left, copies = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            copies = min(copies, left)
            taken.append((length, copies, reach))
            reach |= reach << (length * copies) & mask
            left -= copies
            copies *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, copies, before in reversed(taken):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + copies
            total -= length * copies
    return chosen


def minimum_bin_slack(counts: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``counts[length]`` pieces of each length into bins of ``capacity``.

    Works on counts alone: its time and its result are bounded by the number
    of lengths, not of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    lengths, used, sequence = sorted(left, reverse=True), dict.fromkeys(left, 0), 0
    runs: list[tuple[int, int, int, int]] = []
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        combination = fullest(left, lengths, capacity - longest)
        left[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        bins = min(left[n] // times for n, times in combination.items())
        offset = 0
        for n, times in sorted(combination.items(), reverse=True):
            runs.append((n << _RANK_BITS | used[n], sequence, times, offset))
            offset += n * times
            used[n] += times * bins
            left[n] -= times * bins
        sequence += bins
        lengths = [n for n in lengths if left[n]]
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 4).T
    return Plan(*(c.copy() for c in columns), sequence)


def _place(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, first, times, offsets = plan.value
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            key = length << _RANK_BITS | batch.column("rank").to_numpy()
            at = np.searchsorted(starts, key, side="right") - 1
            j = key - starts[at]
            sequence = first[at] + j // times[at]
            offset = offsets[at] + j % times[at] * length
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, carry: DataFrame | None = None,
         capacity: int = CAPACITY) -> DataFrame:
    """``carry`` (by default the pieces without their ids) with sequence_id and
    offset.  ``carry`` must have length, part and place of ``pieces``."""
    rows = pieces.drop("ids") if carry is None else carry
    spark = pieces.sparkSession
    counts = cut(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # At most `capacity` rows, whatever the number of pieces.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(
        F.sum("n").alias("n")).collect()}
    plan = minimum_bin_slack(histogram, capacity)
    runs = spark.sparkContext.broadcast((plan.key, plan.first, plan.times, plan.offset))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    ranks = counts.select(F.col("length").alias("r_length"), F.col("part").alias("r_part"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("r_before"))
    same = (F.col("length") == F.col("r_length")) & (F.col("part") == F.col("r_part"))
    ranked = (rows.join(ranks, same)
              .withColumn("rank", F.col("place") + F.col("r_before"))
              .drop("r_length", "r_part", "r_before", "place", "part"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                       for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(_place(runs), schema + ", sequence_id long, offset long")


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the tokens of every sequence.  ``packed``: pieces
    with ids, sequence_id and offset; a sequence holds at most the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "").alias("_hex")).select(
        "sequence_id", F.unhex("_hex").alias("ids"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Every piece of ``docs`` with its checksum and its place."""
    pieces = tokenize(docs, tokenizer or default_tokenizer())
    narrow = pieces.select("doc_id", "piece", "start", "length",
                           F.crc32("ids").alias("ids_crc32"), "part", "place")
    return pack(pieces, narrow).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        "sequence_id", "offset")


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents, packed."""
    return pack_documents(documents(spark, sf_dir))
