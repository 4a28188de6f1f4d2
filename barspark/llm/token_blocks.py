"""Token ids as fixed-width bit-packed block files.

A *block file* is one binary value: a header, the offsets of its documents (in ids), the offsets of its
blocks (in bytes) and the blocks.  Each id takes the fewest bits that hold the vocabulary; each block
holds ``BLOCK_IDS`` ids (the last fewer) and starts on a byte, so a reader unpacks any range of ids by
reading only the blocks it touches.  Numpy packs and unpacks a block at once.

Layout (little-endian)::

    magic 'BPK1' | u32 bits | u64 ids | u64 documents | u32 ids per block | u32 blocks
    u64[documents + 1] first id of each document | u64[blocks + 1] byte offset of each block | payload

Files live in a Parquet table (``shard, before, doc_ids, n_ids, blob``) in the shared folder: a
container that every Hadoop file system can hold and Spark can read back, one row a file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import WordTable, arrow_slices, distinct, gather, kept_by_worker, library_ids, library_tokenizer, runs_of
from barspark.sources import fsutil

MAGIC = b"BPK1"
HEAD = "<4sIQQII"
BLOCK_IDS = 4096
#: Ids after which a file is closed (a document is never split, so a longer one makes a longer file).
FILE_IDS = 1 << 20
#: Words of letters whose ids a worker keeps (about 200 bytes each).
KEPT_WORDS = 250_000
#: Bytes of text whose distinct words are encoded at once.
ENCODE_CHARS = 4_000_000


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold ids 0..vocabulary-1."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive ``bits``-wide little-endian fields."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    field = (ids.astype("<u4").view(np.uint8).reshape(-1, 4)) if ids.size else np.zeros((0, 4), np.uint8)
    return np.packbits(np.unpackbits(field, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


def unpack_bits(raw: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed run."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


def write_file(docs: list[np.ndarray], bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """The block file of some documents' ids."""
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    if ids.size and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    starts = np.concatenate([[0], np.cumsum([d.size for d in docs])]).astype("<u8")
    blocks = [pack_bits(ids[i : i + block_ids], bits) for i in range(0, ids.size, block_ids)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    head = struct.pack(HEAD, MAGIC, bits, ids.size, len(docs), block_ids, len(blocks))
    return b"".join([head, starts.tobytes(), offsets.tobytes(), *blocks])


class BlockFile:
    """Reader of one block file; ``ids(a, b)`` unpacks only the blocks that hold that range."""

    def __init__(self, raw: bytes):
        magic, self.bits, self.n_ids, self.n_docs, self.block_ids, n_blocks = struct.unpack_from(HEAD, raw)
        if magic != MAGIC:
            raise ValueError("not a block file")
        at = struct.calcsize(HEAD)
        self.doc_starts = np.frombuffer(raw, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.offsets = np.frombuffer(raw, "<u8", n_blocks + 1, at).astype(np.int64)
        self.raw, self.payload = raw, at + 8 * (n_blocks + 1)

    def ids(self, a: int, b: int) -> np.ndarray:
        if b <= a:
            return np.zeros(0, np.uint32)
        first, last = a // self.block_ids, (b - 1) // self.block_ids
        parts = []
        for k in range(first, last + 1):
            raw = self.raw[self.payload + self.offsets[k] : self.payload + self.offsets[k + 1]]
            parts.append(unpack_bits(raw, min(self.block_ids, self.n_ids - k * self.block_ids), self.bits))
        flat = np.concatenate(parts)
        return flat[a - first * self.block_ids : b - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.doc_starts[i]), int(self.doc_starts[i + 1]))


def encode_documents(
    docs: DataFrame, load: Callable[[], Callable[[list[str]], list[bytes]]], vocabulary: str, size: int, end_id: int | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n, ids`` (packed to the width of ``size`` ids) of whole texts by a tokenizer that treats words apart.

    ``vocabulary`` names what ``load()`` gives (workers keep it by that name): a function from a list
    of words to each word's ids as bytes, or an object whose ``runs(words)`` gives the ids of an Arrow array of
    distinct words (:func:`runs_of`).  The tokenizer must drop white space, so that a text's ids
    are its space-separated words' ids joined.  Arrow splits a slice of texts and numbers its distinct words; these are
    encoded, and numpy joins the ids back by word number.  Null text has no ids but ``end_id``, which closes
    each document when given.  Repeated rows are encoded each; an empty table gives no rows.
    """
    end = np.zeros(0, "<u4") if end_id is None else np.array([end_id], "<u4")
    bits = bits_for(size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("word ids", vocabulary), load)
        ids_of = getattr(encoder, "runs", None) or (lambda words: runs_of(encoder(words.to_pylist())))
        for part, texts in arrow_slices(batches, "t", ENCODE_CHARS):
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            words, rows = distinct(lists.flatten())
            flat, at = ids_of(words)
            ids = gather(flat, at, rows)
            # ids up to each document's first word
            upto = np.concatenate([[0], np.cumsum((at[1:] - at[:-1])[rows])])
            starts = upto[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])].tolist()
            docs = [np.concatenate([ids[a:b], end]) for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([d.size for d in docs], pa.int64()), pa.array([pack_bits(d, bits) for d in docs], pa.binary())], names=["id", "n", "ids"]
            )

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, "id bigint, n bigint, ids binary"
    )


class WordEnds:
    """Ids of words from a tokenizer file whose pieces mark the end of a word.

    Most words are plain letters with some marks after them.  Their letters, lower-cased, are joined to
    lines that the library encodes at once, and cut again at the word-end pieces (one per word of letters);
    marks are encoded once each.  All other words go through the library one by one.
    """

    #: Letters of Latin-1 and marks that end no contraction: between the two a pre-token always ends.
    LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    MARKS = ".,!?;:|#%*&$"
    LINE = 512

    def __init__(self, path: str):
        self.tok = library_tokenizer(path)
        suffix = self.tok.model.end_of_word_suffix
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for p, i in vocab.items() if suffix and p.endswith(suffix)]] = True
        self.cores = WordTable(self.letters, KEPT_WORDS)
        self.marks = WordTable(lambda words: library_ids(self.tok, words))

    def letters(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        runs = [words[a : a + self.LINE] for a in range(0, len(words), self.LINE)]
        for a in range(0, len(runs), 16):
            own = runs[a : a + 16]
            for line, encoded in zip(own, self.tok.encode_batch_fast([" ".join(r) for r in own], add_special_tokens=False)):
                ids = np.array(encoded.ids, "<u4")
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(cuts) == len(line) and cuts[-1] == ids.size:
                    raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                    out += [raw[x:y] for x, y in zip(at, at[1:])]
                else:
                    out += library_ids(self.tok, line)
        return out

    def runs(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words: each is its letters' run and its marks' run, or its own run and an empty one."""
        letters = pc.utf8_rtrim(words, characters=self.MARKS)
        marks = pc.utf8_ltrim(words, characters=self.LETTERS)
        whole = pc.add(pc.binary_length(letters), pc.binary_length(marks))
        plain = pc.and_(pc.equal(whole, pc.binary_length(words)), pc.greater(pc.binary_length(letters), 0))
        cores, core = distinct(pc.utf8_lower(letters.filter(plain)))
        ends, end = distinct(marks.filter(plain))
        other = words.filter(pc.invert(plain)).to_pylist()
        flat, at = runs_of([*self.cores.get(cores.to_pylist()), *self.marks.get(ends.to_pylist()), *library_ids(self.tok, other), b""])
        is_plain = plain.to_numpy(zero_copy_only=False)
        first, second = np.empty(len(words), np.int64), np.full(len(words), len(at) - 2, np.int64)
        first[is_plain], second[is_plain] = core, len(cores) + end
        first[~is_plain] = len(cores) + len(ends) + np.arange(len(other))
        size = at[1:] - at[:-1]
        return gather(flat, at, np.stack([first, second], axis=1).ravel()), np.concatenate([[0], np.cumsum(size[first] + size[second])])

    def __call__(self, words: list[str]) -> list[bytes]:
        flat, at = self.runs(pa.array(words, pa.string()))
        return [flat[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _compact(rows: DataFrame, name: str) -> DataFrame:
    """``materialize`` in smaller files: packed ids shrink by a quarter under zstandard."""
    path = fsutil.scratch(rows.sparkSession, name)
    rows.write.mode("error").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_blocks(encoded: DataFrame, vocabulary: int, name: str = "token_blocks", file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``encode_documents`` rows in ascending id order as block files; returns the written table.

    The packed rows are written once, then range-partitioned by id (null ids first, repeated ids ordered
    by their content); each partition is one shard and writes files of about ``file_ids`` ids.  ``shard`` and ``before`` (ids of the shard's earlier files) give the global order.
    An empty table gives no files.
    """
    bits = bits_for(vocabulary)
    parts = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[np.ndarray] = []
        ids: list[int | None] = []
        held, before = 0, 0

        def close():
            nonlocal docs, ids, held, before
            row = [[before], [ids], [held], [write_file(docs, bits)]]
            docs, ids, held, before = [], [], 0, before + held
            types = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], names=["before", "doc_ids", "n_ids", "blob"])

        for batch in batches:
            for i, n, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                docs.append(unpack_bits(raw, n, bits))
                ids.append(i)
                held += n
                if held >= file_ids:
                    yield close()
        if docs:
            yield close()

    staged = _compact(encoded, f"{name}_ids")
    placed = staged.repartitionByRange(parts, "id", "n").sortWithinPartitions("id", "n", "ids")
    written = placed.mapInArrow(files, "before bigint, doc_ids array<bigint>, n_ids bigint, blob binary")
    return _compact(written.withColumn("shard", F.spark_partition_id()), name)


def read_blocks(files: DataFrame) -> DataFrame:
    """``id, start, n, ids_crc32`` of every document, unpacked from the files.

    ``start`` counts the ids of all documents before it: those of the shards before (per-shard totals, one
    number a shard, come to the driver), of the shard's files before, and of the file's documents before.
    """
    totals = dict(files.groupBy("shard").agg(F.sum("n_ids")).collect())
    starts, at = {}, 0
    for s in sorted(totals):
        starts[s], at = at, at + totals[s]
    placed = files.select("shard", "before", "doc_ids", "blob")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, ids, blob in zip(*(batch.column(k).to_pylist() for k in range(4))):
                f = BlockFile(blob)
                first = starts[shard] + before
                flat = f.ids(0, f.n_ids).astype("<u4")
                crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(f.doc_starts[:-1].tolist(), f.doc_starts[1:].tolist())]
                cols = [ids, (first + f.doc_starts[:-1]).tolist(), np.diff(f.doc_starts).tolist(), crc]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "start", "n", "ids_crc32"])

    return placed.mapInArrow(run, "id bigint, start bigint, n bigint, ids_crc32 bigint")
