"""Token counts by rank-synchronous array merging.

A piece vocabulary (unigram-free BPE with byte fallback, read from its model file) merges, in one text,
the adjacent pair whose joined piece has the lowest rank, leftmost first, until no pair joins.  No
piece holds white space after another character, so texts fall apart into pre-tokens (a run of spaces
with the word after it) that merge independently.

The pre-tokens of a batch are ragged numpy arrays: one flat symbol array and one start per sequence.
Each round finds every active sequence's lowest-rank pair (its leftmost occurrence) with one
``minimum.reduceat`` and applies all of them at once; sequences without a mergeable pair retire with
their symbol count.  Only one occurrence per sequence and round is merged: a join can form a pair of
still lower rank, which must come first.

Pre-tokens are cut where two neighbouring characters stand together in no piece (exact).  What is still
longer than ``LONG`` symbols - runs such as one repeated character - would need a round per merge over
the whole run, so it takes the same merges from a priority queue instead; the counts are the same.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import NumberTable, kept_by_worker, sums_by_text, text_slices

SPACE = "▁"
NONE = np.iinfo(np.int32).max
LONG = 512
_CHUNK = 50_000


class PieceMerger:
    """Merge tables of a piece vocabulary: ``pieces`` in rank order; ``rank`` is the position.

    ``pieces`` are the mergeable pieces only (no control, unknown or byte pieces); single characters
    that no piece equals count their UTF-8 bytes.
    """

    def __init__(self, pieces: list[str]):
        self.rank = {p: i for i, p in enumerate(pieces)}
        chars = sorted({c for p in pieces for c in p})
        # Symbols: the pieces, then characters that occur only inside longer pieces.
        symbol = dict(self.rank)
        for c in chars:
            symbol.setdefault(c, len(symbol))
        self.of_char = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.of_char[ord(c)] = symbol[c]
        self.base = len(symbol) + 1
        pairs: dict[int, int] = {}
        neighbours = set()
        for p, r in self.rank.items():
            neighbours.update(ord(a) << 21 | ord(b) for a, b in zip(p, p[1:]))
            for k in range(1, len(p)):
                left, right = symbol.get(p[:k]), symbol.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = r
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in sorted(pairs)], np.int32)
        self.neighbours = np.array(sorted(neighbours), np.int64)
        self.single = np.zeros(self.base, bool)  # symbols that are whole pieces
        self.single[: len(pieces)] = True
        self.newline_alone = "\n" not in chars
        self.table = NumberTable(self.counts)
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece holds white space after another character: texts can't be cut there")

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair; NONE where the pair does not join."""
        key = left.astype(np.int64) * self.base + right
        key[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], NONE) if len(self.pair_keys) else np.full(len(key), NONE, np.int32)

    def counts(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word (spaces already written as the space mark)."""
        out = [self._counts(words[i : i + _CHUNK]) for i in range(0, len(words), _CHUNK)]
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def _counts(self, words: list[str]) -> np.ndarray:
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word_of = np.repeat(np.arange(len(words)), lengths)
        total = np.zeros(len(words), np.int64)
        if not code.size:
            return total
        sym = self.of_char[code]
        # Cut where neighbours stand together in no piece, and at word ends.
        if len(self.neighbours):
            key = code[:-1] << 21 | code[1:]
            at = np.minimum(np.searchsorted(self.neighbours, key), len(self.neighbours) - 1)
            cut = (self.neighbours[at] != key) | (word_of[1:] != word_of[:-1])
        else:
            cut = np.ones(code.size - 1, bool)
        starts = np.concatenate([[0], np.flatnonzero(cut) + 1])
        # A character outside the pieces stands alone and costs its bytes.
        alone = self.single[sym] & (sym >= 0)
        cost = np.where(alone, 1, np.select([code < 0x80, code < 0x800, code < 0x10000], [1, 2, 3], 4))
        size = np.diff(np.append(starts, code.size))
        owner = word_of[starts]
        one = size == 1
        np.add.at(total, owner[one], cost[starts[one]])
        for k in np.flatnonzero(size > LONG):
            total[owner[k]] += self._merge_long(sym[starts[k] : starts[k] + size[k]].tolist(), cost[starts[k] : starts[k] + size[k]].tolist())
        short = np.flatnonzero((size > 1) & (size <= LONG))
        if short.size:
            np.add.at(total, owner[short], self._merge_rounds(sym, cost, starts[short], size[short]))
        return total

    def _merge_rounds(self, sym: np.ndarray, cost: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        sym, cost = sym[at].copy(), cost[at].copy()
        seq = np.arange(len(size))  # which result each active sequence is
        done = np.zeros(len(size), np.int64)
        rank = np.full(sym.size, NONE, np.int32)  # of the pair (i, i + 1); NONE at a sequence's end
        rank[:-1] = self.pair_ranks(sym[:-1], sym[1:])
        rank[np.cumsum(size) - 1] = NONE
        while size.size:
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            low = np.minimum.reduceat(rank, first)
            live = low < NONE
            if not live.all():
                done[seq[~live]] = np.add.reduceat(cost, first)[~live]
                stay = np.repeat(live, size)
                sym, cost, rank, size, seq, low = sym[stay], cost[stay], rank[stay], size[live], seq[live], low[live]
                if not size.size:
                    break
                first = np.concatenate([[0], np.cumsum(size)[:-1]])
            hit = np.flatnonzero(rank == np.repeat(low, size))
            owner = np.searchsorted(first, hit, "right") - 1
            hit = hit[np.concatenate([[True], owner[1:] != owner[:-1]])]  # leftmost of each sequence
            sym[hit], cost[hit] = low, 1
            keep = np.ones(sym.size, bool)
            keep[hit + 1] = False
            sym, cost, rank = sym[keep], cost[keep], rank[keep]
            size = size - 1
            hit = hit - np.arange(hit.size)  # one symbol went from each sequence before
            end = np.cumsum(size) - 1
            rank[hit] = NONE
            right = hit < end
            rank[hit[right]] = self.pair_ranks(sym[hit[right]], sym[hit[right] + 1])
            left = hit > end - size + 1
            rank[hit[left] - 1] = self.pair_ranks(sym[hit[left] - 1], sym[hit[left]])
        return done

    def _merge_long(self, sym: list[int], cost: list[int]) -> int:
        """The same merges for one long sequence, lowest rank first from a heap of positions."""
        n = len(sym)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        table = self.__dict__.setdefault("_pairs", dict(zip(self.pair_keys.tolist(), self.pair_rank.tolist())))

        def pair(i: int) -> int | None:
            j = nxt[i]
            return table.get(sym[i] * self.base + sym[j]) if j < n and sym[i] >= 0 and sym[j] >= 0 else None

        heap = [(r, i, sym[i], sym[nxt[i]]) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            if not alive[i] or sym[i] != a or nxt[i] >= n or sym[nxt[i]] != b:
                continue
            j = nxt[i]
            sym[i], cost[i], alive[j] = r, 1, False
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for k in (prv[i], i):
                if k >= 0 and (q := pair(k)) is not None:
                    heapq.heappush(heap, (q, k, sym[k], sym[nxt[k]]))
        return sum(c for c, a in zip(cost, alive) if a)


def load_pieces(path: str) -> list[str]:
    """The mergeable pieces of a piece model in rank order (control, unknown and byte pieces left out)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    ids.sort(key=lambda i: (-sp.get_score(i), i))
    return [sp.id_to_piece(i) for i in ids]


def count_texts(texts: list[str], merger: PieceMerger, table: NumberTable) -> np.ndarray:
    """Tokens of each text: the sum over its pre-tokens, each distinct one merged once while kept."""
    cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+" if merger.newline_alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    words = [cut.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
    flat = [w for ws in words for w in ws]
    rows = table.rows(flat)
    counts = sums_by_text(table.matrix[rows] if flat else np.zeros(0, np.int64), [len(w) for w in words])
    return counts + (np.array([t.count("\n") for t in texts], np.int64) if merger.newline_alone else 0)


def count_tokens(docs: DataFrame, load: Callable[[], list[str]], vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` of whole texts; ``load()`` gives the pieces of
    ``vocabulary`` in rank order on a worker, which keeps them by that name.

    Null and empty texts have 0 bytes and 0 tokens.  Repeated rows are counted each; other columns are
    ignored; an empty table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = kept_by_worker(("pieces", vocabulary), lambda: PieceMerger(load()))
        table = merger.table  # kept by the worker process between its tasks
        for part, texts in text_slices(batches, "t"):
            size = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(count_texts(texts, merger, table), pa.int64())], names=["id", "n_bytes", "n_tokens"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, "id bigint, n_bytes bigint, n_tokens bigint"
    )
