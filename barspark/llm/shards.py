"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0..n-1 in the order of their id; the permutation of [0, n) sends row r to position
p, whose shard is ``p mod shards`` and whose slot is ``p div shards``.  The position is a pure
function of (r, n, seed), and ``row_at`` inverts it, so a reader can compute which row any slot holds.
Shard sizes differ by at most one row (law ``rows``).

The permutation works on pairs (left, right) in Z_a x Z_b with a*b >= n and a, b about sqrt(n): a round
adds a keyed hash of one half to the other, modulo that half's size.  Numbers that land at n or above
walk on along their cycle until they come back below n; a*b exceeds n by at most 2 sqrt(n) + 1, so
few rows walk at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.llm.common import numbered, orderable

ROUNDS = 6
PRIME = (1 << 31) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """(multiplier, offset, second multiplier) of each round, below ``PRIME``, from ``seed``."""
    rng = np.random.default_rng(seed)
    return [tuple(int(x) for x in rng.integers(1, PRIME, 3)) for _ in range(rounds)]


def _hash(x: np.ndarray, key: tuple[int, int, int]) -> np.ndarray:
    mul, add, mul2 = key
    t = (x % PRIME * mul + add) % PRIME
    t ^= t >> 15
    return t % PRIME * mul2 % PRIME


class Permutation:
    """Bijection of [0, n); ``forward`` and ``inverse`` take and return int64 arrays."""

    def __init__(self, n: int, seed: int = 0, rounds: int = ROUNDS):
        self.n, self.keys = n, round_keys(seed, rounds)
        self.a = max(1, math.isqrt(max(n - 1, 0)) + 1)
        self.b = max(1, -(-n // self.a))

    def _round_trip(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x // self.b, x % self.b
        for i, key in reversed(list(enumerate(self.keys))) if back else enumerate(self.keys):
            sign = -1 if back else 1
            if i % 2 == 0:
                left = (left + sign * (_hash(right, key) % self.a)) % self.a
            else:
                right = (right + sign * (_hash(left, key) % self.b)) % self.b
        return left * self.b + right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        out = self._round_trip(np.asarray(x, np.int64), back)
        while (far := np.flatnonzero(out >= self.n)).size:
            out[far] = self._round_trip(out[far], back)
        return out

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, False)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, True)


def slot_of(row: np.ndarray, n: int, shards: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    p = Permutation(n, seed).forward(row)
    return p % shards, p // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int = 0) -> np.ndarray:
    """Row number held by a shard's slot (the inverse of ``slot_of``)."""
    return Permutation(n, seed).inverse(np.asarray(slot, np.int64) * shards + np.asarray(shard, np.int64))


def assign_shards(rows: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``row_no``, ``shard`` and ``slot``; ``order`` gives the global row order.

    Ties in ``order`` are broken by the other sortable columns, so only rows equal in all of them may
    swap; null order values come first.  An empty table gives no rows.  Pass narrow rows: they
    are shuffled once and written once.  Columns named like the three new ones are replaced.
    """
    base = rows.drop("row_no", "shard", "slot")
    ties = [c for c in orderable(base, base.columns) if c not in order]
    placed, n = numbered(base, [F.col(c) for c in [*order, *ties]])
    at = placed.columns.index("row_no")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, slot = slot_of(batch.column(at).to_numpy(zero_copy_only=False), n, shards, seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard, pa.int32()), pa.array(slot, pa.int64())], names=[*batch.schema.names, "shard", "slot"]
            )

    schema = T.StructType([*placed.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return placed.mapInArrow(run, schema)
