"""Byte-level BPE by a distinct-word table.

Texts are split in Spark into words whose encodings are independent (white space runs start a word), and
each distinct word of the corpus is encoded once:

1. *split*: every task builds the table of its block's distinct words (a block is a task's documents up
   to ``BLOCK_CHARS`` characters) and deals the words to partitions by hash;
2. *encode*: a partition holds all blocks' occurrences of its words and encodes each word once;
3. *join by position*: the ids return to their block, where every document is a list of word numbers;
   a document's ids are its words' ids in order;
4. *decode*: each id is joined with its piece (the piece table's size is the vocabulary's, so it
   travels with the tasks); the pieces' bytes in order are the text.

Blocks, not words, are the rows that move: a word list or a group of documents' word numbers is one compressed
binary.  Arrow numbers a block's distinct words over the texts' own bytes; numpy joins ids back.  The split
runs once for the word table and once for the documents; a block's signature (hash of its words in order) shows
that both runs saw the same rows, otherwise the task fails with advice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import (
    NumberTable, WordTable, arrow_slices, distinct, forget_kept, gather, kept_by_worker, library_ids, library_tokenizer, runs_of, sums_by_text,
)

#: Bytes of a block; a task's documents beyond it start another block.  A longer text is a block.
BLOCK_BYTES = 16_000_000
#: Words of a group of documents that move as one row (a longer document is a group).
GROUP_WORDS = 50_000
#: Most partitions of the word table.  A block sends one row to each: with more of them the rows would shrink
#: to single words.  A partition reads its rows one by one, so its memory does not grow with the corpus.
WORD_PARTITIONS = 2048
#: ASCII white space, and last and next to last bytes of other white space (both together: no cut, which is always safe).
_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_WIDE_LAST = np.isin(np.arange(256), [*range(0x80, 0x8B), 0xA0, 0xA8, 0xA9, 0xAF, 0x9F])
_WIDE_BEFORE = np.isin(np.arange(256), [0xC2, 0x9A, 0x80, 0x81])


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts in order, words of each text) that byte-level BPE encodes independently.

    A cut stands before a space or newline that follows a non-space, so that no run of white space is cut.  A text's words
    joined are the text.  The words share the texts' memory.
    """
    n, raw = len(texts), texts.buffers()
    at = np.frombuffer(raw[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    size = int(at[-1] - at[0])
    if not size:
        return pa.array([], pa.string()), np.zeros(n, np.int64)
    data = np.frombuffer(raw[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    cut = np.zeros(size + 1, bool)
    gap = (data == 32) | (data == 10)
    cut[1:size] = gap[1:] & ~_SPACE[data[:-1]]
    wide = np.flatnonzero(cut[2:size] & _WIDE_LAST[data[1:-1]] & _WIDE_BEFORE[data[:-2]]) + 2
    cut[wide] = False
    cut[at[:-1]] = True  # each text starts a word (an empty one shares the next one's start)
    cut[size] = False
    starts = np.flatnonzero(cut)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, size).astype(np.int32)), pa.py_buffer(data))
    return words, np.diff(np.searchsorted(starts, at))


def split_words(text: str) -> list[str]:
    """The words of one text, see :func:`cut_words`."""
    return cut_words(pa.array([text], pa.string()))[0].to_pylist()


class Codec:
    """``encode(words) -> id lists`` of a byte-level BPE tokenizer file and the bytes of each id."""

    def __init__(self, path: str):
        self.tok = tok = library_tokenizer(path)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        added = {i: t.content for i, t in tok.get_added_tokens_decoder().items()}
        vocab = {i: p for p, i in tok.get_vocab().items()}
        pieces = [
            added[i].encode() if i in added else bytes(byte_of[c] for c in vocab.get(i, "")) for i in range(max(vocab, default=-1) + 1)
        ]
        self.piece_at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def encode(self, words: list[str]) -> list[bytes]:
        return library_ids(self.tok, words)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ids: each joined with its piece."""
        return gather(self.piece_bytes, self.piece_at, ids).tobytes()


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as compressed byte planes."""
    return zstandard.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_numbers(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_words(words: list[bytes]) -> bytes:
    sizes = np.array([len(w) for w in words], "<u4")
    return zstandard.compress(len(words).to_bytes(4, "little") + sizes.tobytes() + b"".join(words), 1)


def unpack_words(raw: bytes) -> list[bytes]:
    raw = zstandard.decompress(raw)
    n = int.from_bytes(raw[:4], "little")
    at = np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)]) + 4 + 4 * n
    return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray, list, np.ndarray]]:
    """(block, its distinct words, the number of each word of its texts, their ids, words of each text) of a task's rows."""
    seq, held, part = 0, 0, 0
    words: list[pa.Array] = []
    ids: list = []
    counts: list[np.ndarray] = []
    for batch, texts in arrow_slices(batches, "t"):
        part = batch.column(2)[0].as_py()
        own, count = cut_words(texts)
        words.append(own)
        counts.append(count)
        ids += batch.column(0).to_pylist()
        held += texts.nbytes
        if held >= BLOCK_BYTES:
            yield part << 20 | seq, *distinct(pa.concat_arrays(words)), ids, np.concatenate(counts)
            words, ids, counts, seq, held = [], [], [], seq + 1, 0
    if ids:
        yield part << 20 | seq, *distinct(pa.concat_arrays(words)), ids, np.concatenate(counts)


def _signature(words: pa.Array) -> int:
    """Hash of the distinct words in their order."""
    _, at, data = words.buffers()
    if not len(words):
        return 0
    ends = np.frombuffer(at, np.int32)[words.offset : words.offset + len(words) + 1]
    whole = xxhash.xxh64(memoryview(data)[int(ends[0]) : int(ends[-1])])
    whole.update((ends - ends[0]).tobytes())
    return whole.intdigest() >> 1


_KINDS = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
_NAMES = ["block", "sign", "ids", "at", "body"]
_FIELDS = "block bigint, sign bigint, ids array<bigint>, at binary, body binary"


def _moving(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_KINDS)], names=_NAMES)


def _word_lists(parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for block, table, _, _, _ in _blocks(batches):
            sign, words = _signature(table), table.cast(pa.binary()).to_pylist()
            deal = np.array([xxhash.xxh64_intdigest(w) % parts for w in words], np.int64)
            order = np.argsort(deal, kind="stable")
            cuts = np.flatnonzero(np.diff(deal[order])) + 1
            for own in np.split(order, cuts) if order.size else []:
                row = [block], [sign], [int(deal[own[0]])], [pack_numbers(own)], [pack_words([words[k] for k in own.tolist()])]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["block", "sign", "part", "at", "body"])

    return run


def _encode_lists(load: Callable[[], Codec], name: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_by_worker(("codec", name), load)
        table = WordTable(codec.encode)
        for batch in batches:
            for block, sign, at, body in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4))):
                flat, ends = runs_of(table.get([w.decode() for w in unpack_words(body)]))
                sizes = pack_numbers(np.diff(ends))
                yield _moving([(block, sign, None, at, len(sizes).to_bytes(4, "little") + sizes + pack_numbers(flat))])

    return run


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_kept()
    for block, table, numbers, ids, counts in _blocks(batches):
        sign = _signature(table)
        yield _moving([(block, sign, None, pack_numbers(np.array([len(table)])), None)])  # how many words to expect
        ends = np.concatenate([[0], np.cumsum(counts)])
        group = np.cumsum(counts) // GROUP_WORDS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            yield _moving([(block, sign, ids[a:b], pack_numbers(counts[a:b]), pack_numbers(numbers[ends[a] : ends[b]]))])


class _Block:
    """A block's words and their ids, gathered from its encoded lists."""

    def __init__(self, block: int):
        self.block, self.signs, self.places, self.sizes, self.ids = block, set(), [], [], []
        self.flat = self.at = None

    def add(self, sign: int, place: bytes, body: bytes) -> None:
        n = int.from_bytes(body[:4], "little")
        self.signs.add(sign)
        self.places.append(unpack_numbers(place))
        self.sizes.append(unpack_numbers(body[4 : 4 + n]))
        self.ids.append(unpack_numbers(body[4 + n :]))

    def close(self, sign: int, words: int) -> None:
        """All lists have come: the ids by word number."""
        if sum(map(len, self.places)) != words or self.signs - {sign}:
            raise RuntimeError("the documents changed between two reads; write them to a table first")
        none = [np.zeros(0, "<u4")]
        places, sizes = (np.concatenate(x or none).astype(np.int64) for x in (self.places, self.sizes))
        came = np.empty(words, np.int64)
        came[places] = np.arange(words)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        self.flat = gather(np.concatenate(self.ids or none), starts, came)
        self.at = np.concatenate([[0], np.cumsum(sizes[came])])
        self.places, self.sizes, self.ids = [], [], []


def _join_by_position(load: Callable[[], Codec], name: str):
    """Rows sorted by (block, kind): the words' ids, the block's word count, then its documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_by_worker(("codec", name), load)
        now = _Block(-1)
        for batch in batches:
            for i in range(batch.num_rows):
                block, sign, kind = (batch.column(k)[i].as_py() for k in range(3))
                place, body = batch.column(4)[i].as_py(), batch.column(5)[i].as_py()
                if block != now.block:
                    now = _Block(block)
                if kind == 0:
                    now.add(sign, place, body)
                elif kind == 1:
                    now.close(sign, int(unpack_numbers(place)[0]))
                else:
                    yield _texts(codec, now, batch.column(3)[i].values, unpack_numbers(place), unpack_numbers(body))

    return run


def _texts(codec: Codec, block: _Block, ids: pa.Array, counts: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """The ids and the decoded texts of a group of documents, by their word numbers."""
    own = gather(block.flat, block.at, rows)
    upto = np.concatenate([[0], np.cumsum((block.at[1:] - block.at[:-1])[rows])])
    ends = upto[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
    raw = gather(codec.piece_bytes, codec.piece_at, own).tobytes()
    size = np.concatenate([[0], np.cumsum((codec.piece_at[1:] - codec.piece_at[:-1])[own])])[ends].tolist()
    text = [raw[a:b].decode("utf-8", "replace") for a, b in zip(size, size[1:])]
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(own.astype(np.int32)))
    return pa.RecordBatch.from_arrays([ids, lists, pa.array(text, pa.string())], names=["id", "ids", "decoded"])


def encode_decode(docs: DataFrame, load: Callable[[], Codec], name: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids (array<int>), decoded`` of whole texts; ``name`` is the vocabulary's name for workers' caches.

    Null text counts as empty: no ids, empty decoded text.  Repeated rows give repeated rows; an empty
    table gives none; other columns are ignored.  Special strings inside texts become their ids, as
    the tokenizer's default does.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("t"), F.spark_partition_id().alias("p"))
    deal = min(parts, WORD_PARTITIONS)
    lists = rows.mapInArrow(_word_lists(deal), "block bigint, sign bigint, part bigint, at binary, body binary")
    encoded = lists.repartition(deal, "part").mapInArrow(_encode_lists(load, name), _FIELDS).withColumn("kind", F.lit(0))
    numbers = rows.mapInArrow(_documents, _FIELDS).withColumn("kind", F.when(F.col("ids").isNull(), 1).otherwise(2))
    both = encoded.unionByName(numbers).select("block", "sign", "kind", "ids", "at", "body")
    placed = both.repartition(parts, "block").sortWithinPartitions("block", "kind")
    return placed.mapInArrow(_join_by_position(load, name), "id bigint, ids array<int>, decoded string")


def token_counter(load: Callable[[], object], name: str) -> Callable[[Column], Column]:
    """A function from a text column to its number of tokens, where the ids themselves aren't wanted (null and empty: 0).

    ``load()`` opens the tokenizer (tokenizers library) of vocabulary ``name`` on a worker, which keeps it with a bounded
    table of its words' counts.  Whole texts are cut as for :func:`encode_decode`; a slice's distinct words are looked up once.
    """

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def lengths() -> NumberTable:
            tok = load()
            return NumberTable(lambda words: np.array([len(ids) // 4 for ids in library_ids(tok, words)], np.int64))

        table = kept_by_worker(("lengths", name), lengths)
        for texts in batches:
            sums = [np.zeros(0, np.int64)]
            for _, part in arrow_slices([pa.RecordBatch.from_arrays([texts], ["t"])], "t"):
                words, counts = cut_words(part)
                seen, at = distinct(words)
                rows = table.rows(seen.to_pylist())
                sums.append(sums_by_text(table.matrix[rows][at].astype(np.int64), counts))
            yield pa.array(np.concatenate(sums), pa.int64())

    return F.arrow_udf(count, "bigint")
