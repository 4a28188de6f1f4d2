"""Fill-in-the-middle over seekable compressed texts.

A stored text is a run of independent zstandard frames of at most ``FRAME_BYTES`` raw bytes each, beside
three cumulative counts by frame: compressed bytes, lines ended and code points.  A unit is a line
(``[^\\n]*\\n|[^\\n]+``).  The counts tell which frame holds a cut, so that choosing prefix, middle and suffix
decompresses the cut frames alone; the transformed text is written by moving whole frames as they are, with a
frame of its own for each mark and new frames for the pieces of a cut one.  Digests stream a text's frames in
order, one frame in memory at a time.

All steps are map-only: one document is one row, nothing is shuffled, and a lost task is run again alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import text_slices

#: Raw bytes of a frame (the last of a text is shorter).
FRAME_BYTES = 128 << 10
LEVEL = 1
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
_ASIDE = bytes(range(0x80, 0xC0))


def code_points(raw: bytes) -> int:
    """Code points of UTF-8 bytes, also of a piece cut inside one (each counts where it begins)."""
    return len(raw) if raw.isascii() else len(raw.translate(None, _ASIDE))


@dataclass
class Frames:
    """Independent frames in one run of bytes; ``ends``, ``lines`` and ``chars`` are cumulative by frame."""

    body: bytes
    ends: np.ndarray
    lines: np.ndarray
    chars: np.ndarray

    def __len__(self) -> int:
        return len(self.ends)

    def packed(self, a: int, b: int) -> bytes:
        """Frames a..b-1 as they are stored."""
        return self.body[self._before(self.ends, a) : self._before(self.ends, b)]

    def raw(self, k: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.packed(k, k + 1))

    def raw_size(self, k: int) -> int:
        return zstandard.frame_content_size(self.packed(k, k + 1))

    def stream(self, a: int = 0, b: int | None = None) -> Iterator[bytes]:
        """Raw bytes of frames a..b-1, one frame at a time."""
        own = zstandard.ZstdDecompressor()
        for k in range(a, len(self) if b is None else b):
            yield own.decompress(self.packed(k, k + 1))

    @staticmethod
    def _before(counts: np.ndarray, k: int) -> int:
        return int(counts[k - 1]) if k else 0

    def units(self, last_open: bool) -> int:
        """Lines of the text; ``last_open`` says that its last line has no end."""
        return self._before(self.lines, len(self)) + last_open

    def locate(self, unit: int) -> tuple[int, bytes, bytes, int]:
        """The cut before line ``unit`` (0-based): (frame, its raw bytes before and from the cut, code points before).

        A cut at a frame's edge, or after the last line, opens no frame: its pieces are empty.
        """
        if unit == 0:
            return 0, b"", b"", 0
        k = int(np.searchsorted(self.lines, unit))  # first frame that ends so many lines
        if k == len(self):
            return k, b"", b"", self._before(self.chars, k)
        raw = self.raw(k)
        breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
        at = int(breaks[unit - self._before(self.lines, k) - 1]) + 1
        if at == len(raw):
            return k + 1, b"", b"", int(self.chars[k])
        return k, raw[:at], raw[at:], self._before(self.chars, k) + code_points(raw[:at])


class Writer:
    """Collects frames: new ones from raw bytes, or whole ones from another text."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.counts: list[tuple[int, int, int]] = []
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True)

    def text(self, raw: bytes) -> None:
        for a in range(0, len(raw), FRAME_BYTES):
            piece = raw[a : a + FRAME_BYTES]
            self.parts.append(self.zstd.compress(piece))
            self.counts.append((len(self.parts[-1]), piece.count(b"\n"), code_points(piece)))

    def move(self, source: Frames, a: int, b: int) -> None:
        for k in range(a, b):
            self.parts.append(source.packed(k, k + 1))
            self.counts.append((len(self.parts[-1]), *(int(c[k]) - Frames._before(c, k) for c in (source.lines, source.chars))))

    def close(self) -> Frames:
        sums = np.cumsum(np.array(self.counts, np.int64).reshape(-1, 3), axis=0)
        out = Frames(b"".join(self.parts), *sums.T)
        self.parts, self.counts = [], []
        return out


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:doc_id`` (a null id reads as '')."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def cut(source: Frames, n: int, a: int, b: int, form: str, writer: Writer) -> tuple[Frames, int, int]:
    """(transformed text, code points of the prefix and of the middle): lines 0..a, a..b and b..n in the order of ``form``."""
    ka, before_a, from_a, chars_a = source.locate(a)
    kb, before_b, from_b, chars_b = source.locate(b) if b != a else (ka, before_a, from_a, chars_a)

    def prefix():
        writer.move(source, 0, ka)
        writer.text(before_a)

    def middle():
        if a == b:
            return
        if ka == kb and from_a:
            writer.text(from_a[: len(before_b) - len(before_a)])
            return
        writer.text(from_a)
        writer.move(source, ka + bool(from_a), kb)
        writer.text(before_b)

    def suffix():
        writer.text(from_b)
        writer.move(source, kb + bool(from_b), len(source))

    order = [(PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)] if form == "psm" else [(SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle)]
    for mark, section in order:
        writer.text(mark)
        section()
    return writer.close(), chars_a, chars_b - chars_a


def sections(out: Frames) -> dict[bytes, tuple[int, int]]:
    """Frames of each marked section of a transformed text: a mark is a frame of its own, and the text has none."""
    at = [(k, raw) for k in range(len(out)) if out.raw_size(k) == 3 and (raw := out.raw(k)) in MARKS]
    stops = [k for k, _ in at[1:]] + [len(out)]
    return {mark: (k + 1, stop) for (k, mark), stop in zip(at, stops)}


def restored(out: Frames, form: str) -> Iterator[bytes]:
    """The original text from the transformed one and its form, frame by frame."""
    if form == "plain":
        yield from out.stream()
        return
    found = sections(out)
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from out.stream(*found[mark])


def _lists(texts: list[Frames]) -> list[pa.Array]:
    at = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in texts])]), pa.int32())
    flat = [np.concatenate([getattr(f, c) for f in texts]) if texts else np.zeros(0, np.int64) for c in ("ends", "lines", "chars")]
    return [pa.array([f.body for f in texts], pa.binary()), *(pa.ListArray.from_arrays(at, pa.array(x, pa.int64())) for x in flat)]


def _frames(batch: pa.RecordBatch) -> Iterator[Frames]:
    cols = [batch.column(batch.schema.get_field_index(c)) for c in ("body", "ends", "lines", "chars")]
    for i in range(batch.num_rows):
        yield Frames(cols[0][i].as_py(), *(c[i].values.to_numpy(zero_copy_only=False) for c in cols[1:]))


STORED = "body binary, ends array<bigint>, lines array<bigint>, chars array<bigint>"
_STORED_NAMES = ["body", "ends", "lines", "chars"]


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, marked, last_open`` and the frames (``body, ends, lines, chars``) of every whole text.

    ``marked``: the text holds a mark itself; ``last_open``: its last line has no end.  Null text reads as empty (no
    frames).  Repeated rows give repeated rows, an empty table none; other columns are ignored.  A text of any
    length is one row, held once raw and once compressed while it is stored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer()
        for part, texts in text_slices(batches, "t"):
            marked, open_, out = [], [], []
            for raw in texts:
                raw = raw or b""
                writer.text(raw)
                out.append(writer.close())
                marked.append(any(m in raw for m in MARKS))
                open_.append(bool(raw) and not raw.endswith(b"\n"))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(marked, pa.bool_()), pa.array(open_, pa.bool_()), *_lists(out)], names=["id", "marked", "last_open", *_STORED_NAMES]
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(run, f"id bigint, marked boolean, last_open boolean, {STORED}")


def transform(stored: DataFrame, seed: int, rate: int = 100, spm: int = 50) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars`` and the transformed text's frames, of the rows of :func:`store`.

    ``rate`` percent of the texts are transformed, ``spm`` percent of them with the suffix first, as the draws of
    the id decide.  Empty texts and those that hold a mark stay plain (prefix and middle are null).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer()
        for batch in batches:
            ids, marked, open_ = (batch.column(k).to_pylist() for k in range(3))
            rows: list[list] = [[], [], [], []]
            out = []
            for i, m, o, text in zip(ids, marked, open_, _frames(batch)):
                n = text.units(o)
                h1, h2, h3, h4 = draws(i, seed)
                if n == 0 or m or h3 % 100 >= rate:
                    done = ("plain", None, None)
                    out.append(text)
                else:
                    form = "spm" if h4 % 100 < spm else "psm"
                    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                    made, prefix, middle = cut(text, n, a, b, form, writer)
                    out.append(made)
                    done = (form, prefix, middle)
                for col, v in zip(rows, (n, *done)):
                    col.append(v)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(rows, kinds)), *_lists(out)], names=["id", "n", "form", "prefix_chars", "middle_chars", *_STORED_NAMES]
            )

    return stored.mapInArrow(run, f"id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, {STORED}")


def digests(transformed: DataFrame) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``: both texts streamed from the frames."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[str]] = [[], []]
            for form, text in zip(batch.column(2).to_pylist(), _frames(batch)):
                whole = hashlib.sha256()
                for piece in text.stream():
                    whole.update(piece)
                back = whole
                if form != "plain":
                    back = hashlib.sha256()
                    for piece in restored(text, form):
                        back.update(piece)
                out[0].append(whole.hexdigest())
                out[1].append(back.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), *(pa.array(c, pa.string()) for c in out)],
                names=["id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
            )

    return transformed.mapInArrow(run, "id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string")


def texts(transformed: DataFrame) -> DataFrame:
    """``id, form, output`` with the transformed text whole."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [b"".join(t.stream()).decode() for t in _frames(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.string())], names=["id", "form", "output"])

    return transformed.mapInArrow(run, "id bigint, form string, output string")
