"""EMA and MACD of whole histories as a blocked scan of affine maps (W5, W6), on the JVM alone.

One bar changes the state ``s = (fast EMA, slow EMA, signal)`` by an affine map, so a run of ``n`` bars does too:
``s -> A(n) s + c``.  ``A(n)`` depends on the length only: with ``p``, ``q`` and ``b`` the decays of the three
averages and ``w = 1 - b``::

    fast'   = p^n fast                                    + c_fast
    slow'   = q^n slow                                    + c_slow
    signal' = b^n signal + g_p(n) fast - g_q(n) slow      + c_signal        g_r(n) = w r (r^n - b^n) / (r - b)

1. A ticker's rows are cut into blocks of ``block_rows``; running sums of decayed closes inside a block (ordered
   windows) give every row's state as if the block began at zero, and the block's ``c`` at its last row.
2. The blocks' maps are composed by a scan: ``FAN`` blocks a group, the groups' maps again by groups, until one
   group a ticker is left.  The tables shrink by ``FAN`` at each level.
3. Every row adds ``A(k)`` applied to the state carried into its block.  The states of a chunk's blocks are one
   array, joined to its rows where these lie: the join neither moves nor sorts them.

Nothing depends on how long a chunk is (there is no warm-up halo): the result is the recursion from the first
row.  Window tasks hold about ``TASK_ROWS`` rows, in tickers of at most ``chunk_rows`` rows and chunks of longer
ones (:func:`barspark.operators.sequence.frame`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspark.functions.features import MACD_FAST, MACD_SIGNAL, MACD_SLOW, ema_alpha
from barspark.operators.sequence import CHUNK, SEQ, broadcast_if_small, chunk_window, configured_chunk_rows, frame, time_order
from barspark.schemas import DATE, TICKER
from barspark.session import materialize

#: Rows of a block.  Decayed sums are scaled by up to (1 / decay)^rows, which a double must hold.
BLOCK_ROWS = 1024
#: Blocks (or groups of them) whose maps one step of the scan composes.
FAN = 64

_BLOCK, _STEP, _GROUP = "_block", "_step", "_group"
_MAP = ["fast", "slow", "signal"]


class MacdMaps:
    """The maps of one choice of spans, as Column expressions."""

    def __init__(self, fast: int, slow: int, signal: int):
        self.decay = {"fast": 1.0 - ema_alpha(fast), "slow": 1.0 - ema_alpha(slow), "signal": 1.0 - ema_alpha(signal)}
        if len(set(self.decay.values())) < 3:
            raise ValueError("the three spans must differ")

    def power(self, name: str, n: Column) -> Column:
        return F.pow(F.lit(self.decay[name]), n)

    def bridge(self, name: str, n: Column) -> Column:
        """What one unit of an EMA before ``n`` rows leaves in the signal after them."""
        r, b = self.decay[name], self.decay["signal"]
        return F.lit((1.0 - b) * r / (r - b)) * (self.power(name, n) - self.power("signal", n))

    def apply(self, state: dict[str, Column], n: Column, own: dict[str, Column]) -> dict[str, Column]:
        """``A(n) state + own``."""
        moved = {k: self.power(k, n) * state[k] for k in _MAP}
        moved["signal"] = moved["signal"] + self.bridge("fast", n) * state["fast"] - self.bridge("slow", n) * state["slow"]
        return {k: moved[k] + own[k] for k in _MAP}

    def decayed_sum(self, name: str, value: Column, w) -> Column:
        """Running sum of ``value`` decaying by one step a row: a sum scaled up by the step, scaled back."""
        return self.power(name, F.col(_STEP)) * F.sum(value * self.power(name, -F.col(_STEP))).over(w)


def _fields(prefix: str) -> dict[str, Column]:
    return {k: F.col(f"{prefix}{k}") for k in _MAP}


def _then(maps: MacdMaps, first: Column, second: Column) -> Column:
    """One map after another, as structs of ``n`` and the three constants."""
    out = maps.apply({k: first[k] for k in _MAP}, second["n"], {k: second[k] for k in _MAP})
    return F.struct((first["n"] + second["n"]).alias("n"), *[out[k].alias(k) for k in _MAP])


def _carries(blocks: DataFrame, keys: list[str], maps: MacdMaps, fan: int, partitions: int | None = None) -> DataFrame:
    """``keys, _block, in_fast, in_slow, in_signal``: the state before each block, from ``keys, _block, map``.

    A ticker's first block holds its seed in its constants, so the state before it counts as zero.
    ``partitions`` deals out the groups of many blocks.
    """
    w = Window.partitionBy(*keys, _GROUP).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), *[F.lit(0.0).alias(k) for k in _MAP])
    grouped = blocks.withColumn(_GROUP, F.floor(F.col(_BLOCK) / fan))
    grouped = grouped.repartition(partitions, *keys, _GROUP) if partitions else grouped
    before = F.aggregate(F.collect_list("map").over(w), zero, lambda acc, m: _then(maps, acc, m))  # under `fan` maps
    # written: the level above and the rows below read the same prefixes
    placed = materialize(grouped.withColumn("before", before), "ema-blocks")
    if not (placed.agg(F.max(_GROUP)).first()[0] or 0):
        return placed.select(*keys, _BLOCK, *[F.col("before")[k].alias(f"in_{k}") for k in _MAP])
    whole = placed.groupBy(*keys, _GROUP).agg(F.max_by(_then(maps, F.col("before"), F.col("map")), _BLOCK).alias("map"))
    above = _carries(whole.withColumnRenamed(_GROUP, _BLOCK), keys, maps, fan)
    above = above.withColumnRenamed(_BLOCK, _GROUP)
    joined = placed.join(broadcast_if_small(above, above.count()), [*keys, _GROUP])
    state = maps.apply(_fields("in_"), F.col("before")["n"], {k: F.col("before")[k] for k in _MAP})
    return joined.select(*keys, _BLOCK, *[state[k].alias(f"in_{k}") for k in _MAP])


def macd_scan(
    bars: DataFrame,
    keys: list[str] | None = None,
    time: str = DATE,
    chunk_rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
    fast: int = MACD_FAST,
    slow: int = MACD_SLOW,
    signal: int = MACD_SIGNAL,
    fan: int = FAN,
) -> DataFrame:
    """``keys, time, close, ema_<fast>, ema_<slow>, macd, macd_signal`` for every bar, seeded at the first close.

    A bar without a close (null or NaN) leaves the state as it was and has null outputs.  An empty table
    gives no rows.
    """
    maps, keys = MacdMaps(fast, slow, signal), keys or [TICKER]
    if block_rows * max(-math.log(d) for d in maps.decay.values()) > 600:
        raise ValueError(f"blocks of {block_rows} rows overflow a double at these spans")
    order, size = time_order(bars, time), chunk_rows or configured_chunk_rows(bars.sparkSession)
    names = [f"ema_{fast}", f"ema_{slow}", "macd", "macd_signal"]
    has_close = F.col("close").isNotNull() & ~F.isnan("close")
    rows = frame(bars.where(has_close).select(*keys, *order), keys, order, chunk_rows=size)
    dealt, sequenced = rows._barspark_partitions, rows._barspark_sequenced
    per_chunk = -(-size // block_rows)
    # where every row has its position, no window (nor its sort) counts it again
    at = F.col(SEQ) - F.col(CHUNK) * size if sequenced else F.row_number().over(chunk_window(keys, order)) - 1
    rows = rows.withColumn("_at", at.cast("bigint")).withColumns(
        {_BLOCK: F.col(CHUNK) * per_chunk + F.floor(F.col("_at") / block_rows), _STEP: F.col("_at") % block_rows + 1}
    )
    w = Window.partitionBy(*keys, CHUNK, _BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # the state before a ticker's first bar is (first close, first close, 0): the first bar then leaves it as it is
    seed = F.when(F.col(_BLOCK) == 0, F.first("close").over(w)).otherwise(F.lit(0.0))
    own = {k: maps.power(k, F.col(_STEP)) * seed + maps.decayed_sum(k, F.col("close") * (1.0 - maps.decay[k]), w) for k in ("fast", "slow")}
    rows = rows.withColumns({f"own_{k}": c for k, c in own.items()})
    line = (F.col("own_fast") - F.col("own_slow")) * (1.0 - maps.decay["signal"])
    rows = rows.withColumn("own_signal", maps.decayed_sum("signal", line, w))

    last = F.max_by(F.struct(F.col(_STEP).alias("n"), *[F.col(f"own_{k}").alias(k) for k in _MAP]), _STEP)
    # grouped in the order that the windows' rows have
    blocks = rows.groupBy(*keys, CHUNK, _BLOCK).agg(last.alias("map")).drop(CHUNK)
    carried = _carries(blocks, keys, maps, fan, dealt).withColumn(CHUNK, F.floor(F.col(_BLOCK) / per_chunk))
    n_carried = carried.count()
    carried = carried.repartition(dealt, *keys, CHUNK) if dealt else carried
    states = F.sort_array(F.collect_list(F.struct(_BLOCK, *[f"in_{k}" for k in _MAP]))).alias("_states")
    carried = carried.groupBy(*keys, CHUNK).agg(states)  # one state a block of the chunk
    rows = rows.join(broadcast_if_small(carried, n_carried), [*keys, CHUNK])
    before = F.get("_states", (F.col(_BLOCK) - F.col(CHUNK) * per_chunk).cast("int"))
    rows = rows.withColumn("_before", before)
    state = maps.apply({k: F.col("_before")[f"in_{k}"] for k in _MAP}, F.col(_STEP), _fields("own_"))
    out = rows.select(
        *keys, time, "close", state["fast"].alias(names[0]), state["slow"].alias(names[1]),
        (state["fast"] - state["slow"]).alias("macd"), state["signal"].alias("macd_signal"),
    )
    none = [F.lit(None).cast("double").alias(n) for n in names]
    return out.unionByName(bars.where(~F.coalesce(has_close, F.lit(False))).select(*keys, time, "close", *none))
