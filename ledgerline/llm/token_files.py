"""Token ids in binary files: fixed-width bit packing with block offsets.

Every id takes the fewest bits that the vocabulary needs.  A file holds blocks
of :data:`BLOCK` ids (the last may be shorter), then the byte offset of each
block, the documents' ids and where they end, and a fixed-size footer::

    block 0 | block 1 | ... | offsets u64[blocks + 1] | doc_id i64[docs]
    | known u8[docs] | end u64[docs] | footer

Ids are packed least significant bit first.  64 ids of w bits fill w 64-bit
words, so packing and unpacking are 64 shifts over whole columns of such
words, whatever w is; where w is 8, 16 or 32, that is a plain array.  A range
of ids is read by seeking to its blocks.

A table is a folder of files and a manifest that Spark writes.  Documents are
spread by ranges of their id, so that file after file holds them in ascending
order; null ids come last, rows that share an id are ordered by their text's
hash.  A task writes one file under a name of its own and reports it; only
reported files of tasks that Spark committed enter the manifest, so a retried
task or a lost executor leaves at most a file that nobody reads.  The place of
a file's first id in the whole is the sum of the files before it, from the
manifest.

Files are written by the tasks through ``pyarrow.fs`` to the shared folder
(local and mounted paths, ``hdfs``, ``viewfs``, ``s3a``, ``gs``, ``abfss``).

Defined cases: null and empty texts have the end id only; repeated rows are
stored each; an empty table gives no file and an empty result; other columns
are not read; a text is encoded whole, however long it is, and a file holds
at least one whole document: memory follows the longest text, not the table.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, per_worker
from ledgerline.llm.packing import WordTokens, default_tokenizer
from ledgerline.session import fresh_dir

END_ID = 2
BLOCK = 1 << 14          # ids a block, a multiple of 64
MAGIC = b"TOKBITS1"
WHOLE = {8: "u1", 16: "<u2", 32: "<u4"}   # widths whose packing is an array of integers
FOOTER = "<8sIIQQQQQ"   # magic, width, block, docs, ids, three table offsets

MANIFEST = "part int, file string, docs long, ids long, bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    """Bits that hold the ids below ``vocabulary``, at least one."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each (at most 32), the last byte filled with zeros."""
    if width in WHOLE:
        return ids.astype(WHOLE[width]).tobytes()
    n = len(ids)
    lanes = np.zeros((-(-n // 64), 64), np.uint64)
    lanes.reshape(-1)[:n] = ids
    words = np.zeros((len(lanes), width), np.uint64)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        words[:, word] |= lanes[:, k] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, k] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()[:-(-n * width // 8)]


def unpack_bits(packed: bytes, n: int, width: int) -> np.ndarray:
    """The first ``n`` ids of :func:`pack_bits`'s bytes, as 32-bit integers."""
    if width in WHOLE:
        return np.frombuffer(packed, WHOLE[width], n).astype("<u4")
    rows = -(-n // 64)
    words = np.frombuffer(packed.ljust(rows * width * 8, b"\0"), "<u8",
                          rows * width).reshape(rows, width)
    ids, mask = np.empty((rows, 64), "<u4"), np.uint64((1 << width) - 1)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | words[:, word + 1] << np.uint64(64 - shift)
        ids[:, k] = value & mask
    return ids.reshape(-1)[:n]


def located(path: str):
    """(file system, path there) of a folder or file in the shared folder."""
    from pyarrow import fs

    for alias, name in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if path.startswith(alias):
            path = name + path[len(alias):]
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


class Writer:
    """One file, written front to back; holds one block and the document table."""

    def __init__(self, stream, width: int, block: int = BLOCK):
        self.stream, self.width, self.block = stream, width, block
        self.offsets, self.ids = [0], 0
        self.doc_ids: list[int | None] = []
        self.ends: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def _write(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), self.block):
            packed = pack_bits(ids[at:at + self.block], self.width)
            self.stream.write(packed)
            self.offsets.append(self.offsets[-1] + len(packed))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.ids += len(ids)
        self.ends.append(self.ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 16 * self.block:
            together = np.concatenate(self.waiting)
            whole = len(together) // self.block * self.block
            self._write(together[:whole])
            self.waiting, self.held = [together[whole:]], len(together) - whole

    def close(self) -> int:
        """Write what is left, the tables and the footer; the file's size."""
        if self.held:
            self._write(np.concatenate(self.waiting))
        at, places = self.offsets[-1], []
        known = np.array([d is not None for d in self.doc_ids], "u1")
        for table in (np.array(self.offsets, "<u8"),
                      np.array([d or 0 for d in self.doc_ids], "<i8"), known,
                      np.array(self.ends, "<u8")):
            places.append(at)
            self.stream.write(table.tobytes())
            at += table.nbytes
        self.stream.write(struct.pack(FOOTER, MAGIC, self.width, self.block, len(known), self.ids,
                                      places[0], places[1], places[3]))
        self.stream.close()
        return at + struct.calcsize(FOOTER)


class Reader:
    """Random access to one file: the tables are read at once, blocks when asked for."""

    def __init__(self, path: str):
        files, there = located(path)
        self.file = files.open_input_file(there)
        size, last = self.file.size(), struct.calcsize(FOOTER)
        magic, self.width, self.block, docs, self.ids, offsets, doc_ids, ends = struct.unpack(
            FOOTER, self.file.read_at(last, size - last))
        if magic != MAGIC:
            raise ValueError(f"{path}: not a file of token ids")
        blocks = -(-self.ids // self.block)
        self.offsets = np.frombuffer(self.file.read_at(8 * (blocks + 1), offsets), "<u8")
        self.doc_ids = np.frombuffer(self.file.read_at(8 * docs, doc_ids), "<i8")
        self.known = np.frombuffer(self.file.read_at(docs, doc_ids + 8 * docs), "u1").astype(bool)
        self.ends = np.frombuffer(self.file.read_at(8 * docs, ends), "<u8").astype(np.int64)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file: only their blocks are read."""
        stop = min(stop, self.ids)
        if start >= stop:
            return np.empty(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        at = int(self.offsets[first])
        raw = self.file.read_at(int(self.offsets[last + 1]) - at, at)
        parts = []
        for b in range(first, last + 1):
            lo, hi = int(self.offsets[b]) - at, int(self.offsets[b + 1]) - at
            parts.append(unpack_bits(raw[lo:hi], min(self.block, self.ids - b * self.block),
                                     self.width))
        return np.concatenate(parts)[start - first * self.block:stop - first * self.block]

    def document(self, i: int) -> np.ndarray:
        """The ids of the file's ``i``-th document."""
        return self.read(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))

    def close(self) -> None:
        self.file.close()


class Tokens(WordTokens):
    """:class:`WordTokens` that knows words in lower case."""

    def ids(self, text: bytes | None) -> bytes:
        # Lower case now: fewer words to know.  Not where a special token may
        # stand, which is matched before the tokenizer itself lowers the text.
        if text and b"<|" not in text and self.lowers:
            text = text.lower()
        return super().ids(text)

    def __init__(self, path: str):
        super().__init__(path)
        self.lowers = self._encode("A Q").tolist() == self._encode("a q").tolist()


def _write_files(tokenizer: str, folder: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_worker(f"token files {tokenizer}", lambda: Tokens(tokenizer))
        end, writer = np.array([end_id], "<u4").tobytes(), None
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tok"
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    files, there = located(name)
                    files.create_dir(there.rsplit("/", 1)[0], recursive=True)
                    writer = Writer(files.open_output_stream(there), width)
                writer.add(doc_id, np.frombuffer(tokens.ids(text.as_py()) + end, "<u4"))
        if writer is not None:
            size = writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]),
                 pa.array([len(writer.ends)], pa.int64()), pa.array([writer.ids], pa.int64()),
                 pa.array([size], pa.int64())],
                names=["part", "file", "docs", "ids", "bytes"])
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None,
                      doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> str:
    """Write ``docs`` as a table of token files under ``path``; returns ``path``."""
    from tokenizers import Tokenizer

    tokenizer = tokenizer or default_tokenizer()
    size = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    width = bits_for(max(size, end_id + 1))
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("binary").alias("t"),
                       # Rows of one id and text have an order of their own, so that a
                       # range boundary can fall between them.
                       F.xxhash64(F.col(text)).alias("h"),
                       F.monotonically_increasing_id().alias("r"))
    keys = [F.col("d").asc_nulls_last(), F.col("h"), F.col("r")]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("d", "t")
    files = sorted_rows.mapInArrow(
        _write_files(tokenizer, f"{path}/data", end_id, width), MANIFEST)
    files.write.parquet(f"{path}/manifest")
    return path


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The table's files with ``first``, the place of a file's first id.

    One row a file: the window is over files, not over documents or ids.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest").withColumn(
        "first", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               strict=True):
            reader = Reader(file)
            n, step = len(reader.ends), 4096
            begins = np.concatenate([[0], reader.ends[:-1]])
            for at in range(0, n, step):
                stop = min(at + step, n)
                crcs = list(_checksums(reader, begins[at:stop], reader.ends[at:stop]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.doc_ids[at:stop], pa.int64(), mask=~reader.known[at:stop]),
                     pa.array(first + begins[at:stop], pa.int64()),
                     pa.array(reader.ends[at:stop] - begins[at:stop], pa.int64()),
                     pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
            reader.close()


def _checksums(reader: Reader, begins: np.ndarray, ends: np.ndarray) -> Iterator[int]:
    """crc32 of each document's ids; about 16 blocks are held at a time."""
    window, lo, hi = np.empty(0, "<u4"), 0, 0
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        crc, at = 0, begin
        while at < end:
            if not lo <= at < hi:
                lo = at // reader.block * reader.block
                window = reader.read(lo, lo + 16 * reader.block)
                hi = lo + len(window)
            to = min(end, hi)
            crc = zlib.crc32(window[at - lo:to - lo], crc)
            at = to
        yield crc


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a table of token files: doc_id, start, n_tokens and the
    crc32 of its ids (little-endian 32-bit), from the files."""
    files = manifest(spark, path).select("file", "first")
    # A task a file: rows this small would all be coalesced into one otherwise.
    spread = files.repartition(max(1, files.count()))
    return spread.mapInArrow(_read_files, DOCUMENTS)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back."""
    path = write_token_files(documents(spark, sf_dir), fresh_dir(spark, "token-files"))
    return read_token_files(spark, path)
