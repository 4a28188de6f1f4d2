"""Helpers shared by the text operators: slices of Arrow batches, bounded word tables, row numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.session import materialize

#: Characters of text handled at once inside a task; bounds the memory of a step, not its result.
SLICE_CHARS = 2_000_000
#: Distinct words a worker keeps between batches; a full table is emptied and filled again.
TABLE_WORDS = 250_000


def text_slices(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into runs of rows with about ``SLICE_CHARS`` bytes of text; null text reads as ''.

    A single longer text is a slice by itself: whole texts are never cut.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        n = batch.num_rows
        if n == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0).cast(pa.int64()))
        run = np.cumsum(sizes) // SLICE_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            yield part, [t or "" for t in col.slice(a, b - a).to_pylist()]
    give_back()


def arrow_slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """As :func:`text_slices`, with the texts left in Arrow (null reads as '') and about ``limit`` bytes a slice."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        if batch.num_rows == 0:
            continue
        run = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0).cast(pa.int64()))) // limit
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a), pc.fill_null(col.slice(a, b - a), "")
    give_back()


def distinct(words: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """(distinct words in the order they appear, each word's number among them)."""
    coded = pc.dictionary_encode(words)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks() if coded.num_chunks != 1 else coded.chunk(0)
    if isinstance(coded, pa.ChunkedArray):  # no chunk at all
        return pa.array([], words.type), np.zeros(0, np.int32)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def gather(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Runs ``flat[at[r]:at[r + 1]]`` of the rows, joined."""
    size = at[rows + 1] - at[rows]
    ends = np.cumsum(size)
    if not ends.size or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(at[rows] - (ends - size), size) + np.arange(ends[-1])]


def runs_of(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids as bytes, joined: (ids, where each run starts, and the end)."""
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, values), np.int64, len(values)) // 4)])
    return np.frombuffer(b"".join(values), "<u4"), at


def give_back() -> None:
    """Return freed memory to the system: a worker process lives on after its task, beside the tasks of
    later stages, and would keep its peak size."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass


def forget_kept() -> None:
    """Drop what earlier operators keep in this worker (see ``kept_by_worker``)."""
    import sys

    if "_text_operators_kept" in sys.modules:
        sys.modules["_text_operators_kept"].__dict__.pop("values", None)
        give_back()


class WordTable:
    """Word -> value, filled in bulk by ``encode(new_words)`` (one value per new word, never None).

    Holds at most ``limit`` words plus those of one slice: an overfull table is emptied between slices, so
    memory is bounded whatever the vocabulary and no result depends on it.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable], limit: int = TABLE_WORDS):
        self.encode, self.limit = encode, limit
        self.index: dict[str, object] = {}

    def get(self, words: list[str]) -> list:
        """The words' values; unseen words are encoded first, each once."""
        if len(self.index) > self.limit:
            self.index = {}
            self.emptied()
        index = self.index
        got = list(map(index.get, words))
        missing = [i for i, v in enumerate(got) if v is None]
        if missing:
            new = list(dict.fromkeys([words[i] for i in missing]))
            index.update(zip(new, self.encode(new)))
            for i in missing:
                got[i] = index[words[i]]
        return got

    def emptied(self) -> None:
        pass


class NumberTable(WordTable):
    """A word table whose ``encode`` returns one array row per word; ``matrix`` holds them all."""

    def __init__(self, encode: Callable[[list[str]], np.ndarray], limit: int = TABLE_WORDS):
        super().__init__(self._extend, limit)
        self.numbers, self.held, self.used = encode, np.zeros(0), 0

    def emptied(self) -> None:
        self.used = 0

    def _extend(self, words: list[str]) -> range:
        new = self.numbers(words)
        if self.used + len(new) > len(self.held) or self.held.shape[1:] != new.shape[1:]:
            old, room = self.held[: self.used], max(1024, 2 * (self.used + len(new)))
            self.held = np.zeros((room, *new.shape[1:]), new.dtype)
            if self.used:
                self.held[: self.used] = old
        first, self.used = self.used, self.used + len(new)
        self.held[first : self.used] = new
        return range(first, self.used)

    def rows(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words in ``matrix``."""
        return np.array(self.get(words), np.int64)

    @property
    def matrix(self) -> np.ndarray:
        return self.held[: self.used]


def sums_by_text(values: np.ndarray, counts: list[int] | np.ndarray) -> np.ndarray:
    """Sum runs of ``values`` (first axis), run i holding ``counts[i]`` entries; empty runs give 0."""
    ends = np.cumsum(np.asarray(counts, np.int64))
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[ends] - total[ends - np.asarray(counts, np.int64)]


def numbered(df: DataFrame, order: list, name: str = "row_no", partitions: int | None = None) -> tuple[DataFrame, int]:
    """Gapless row numbers from 0 in the order of ``order``, and the row count.

    The rows are range-partitioned and sorted, and written with their position inside the partition,
    so retries and every reader see one numbering.  Only one (partition, count) pair per partition
    comes to the driver.  Keep the rows narrow: they are shuffled once.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()),
        "numbered",
    )
    low = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    part = F.shiftright("_mid", 33)
    sizes = dict(placed.groupBy(part.alias("p")).count().collect())
    starts, at = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(at)
        at += sizes.get(p, 0)
    offsets = spark.createDataFrame(list(enumerate(starts)) or [(0, 0)], "_part bigint, _start bigint")  # one row a partition
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn(name, F.col("_start") + low).drop("_mid", "_part", "_start"), at


def orderable(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns whose type Spark can sort by (no maps or variants inside)."""
    return [c for c in columns if not any(k in df.schema[c].dataType.simpleString() for k in ("map<", "variant"))]


def kept_by_worker(key: tuple, make: Callable[[], object]) -> object:
    """``make()`` once per key and Python worker process, kept for the tasks that follow there.

    The code of this package travels inside the pickled functions, so its module globals are new in
    each task; a module object in ``sys.modules`` outlives them.  Only the last key's value is kept.
    """
    import sys
    import types

    store = sys.modules.setdefault("_text_operators_kept", types.ModuleType("_text_operators_kept")).__dict__.setdefault("values", {})
    if key not in store:
        store.clear()
        give_back()
        store[key] = make()
    return store[key]


#: Words handed to a tokenizer library at once (its results are large objects).
LIBRARY_WORDS = 8_192


def library_ids(tok, words: list[str]) -> list[bytes]:
    """Each word's ids (unsigned 32-bit, little-endian) from a tokenizer of the tokenizers library."""
    out: list[bytes] = []
    for a in range(0, len(words), LIBRARY_WORDS):
        out += [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast(words[a : a + LIBRARY_WORDS], add_special_tokens=False)]
    return out


def library_tokenizer(path: str):
    """A tokenizer file opened on a worker: one thread (Spark runs the tasks), no truncation or padding."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok
