"""Recursive EMA / MACD signal over the full history of each ticker.

``y_t = (1 - a) * y_{t-1} + a * x_t`` seeded with ``y_0 = x_0`` has no built-in Spark form.  It
is still a *bounded* look-back to double precision: starting the recursion ``H`` rows early from
a wrong seed leaves an error factor ``(1 - a)^H``, which for the slowest span (26) is below
1e-20 once ``H`` is about 600.  So the series is cut into the same chunks as every other window
(:mod:`barspark.operators.sequence`), each chunk carries an ``H``-row halo, and the recursion runs
per chunk in Python (pandas ``ewm(adjust=False)``): Spark sorts each task's rows by chunk and time, and
one call computes all the chunks that end in an Arrow batch, so thousands of short tickers cost no
call each.  The first chunk of a ticker starts at its true first row, so short series are exact by
construction.  A call holds at most a batch and one chunk of ``chunk_rows + H`` rows, no matter how
long one ticker is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.functions.columns import nan_to_null
from barspark.functions.features import MACD_FAST, MACD_SIGNAL, MACD_SLOW, Feature, ema_warmup
from barspark.operators.sequence import CHUNK

#: Pieces that the look-back check cuts a group into.
CHECK_CUTS = 64


def ema_halo(slowest_span: int = MACD_SLOW) -> int:
    """Warm-up rows each chunk carries so the recursion is exact to double precision."""
    return ema_warmup(slowest_span)


def _macd_columns(close: pd.Series, group: np.ndarray) -> dict[str, pd.Series]:
    """The recursions over the rows of each group (groups lie together, in order)."""

    def ema(values: pd.Series, span: int) -> pd.Series:
        return values.groupby(group, sort=False).ewm(span=span, adjust=False).mean().reset_index(drop=True)

    fast, slow = ema(close, MACD_FAST), ema(close, MACD_SLOW)
    macd = fast - slow
    return {"ema_12": fast, "ema_26": slow, "macd": macd, "macd_signal": ema(macd, MACD_SIGNAL)}


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """For every row but the first: does it begin another group?  Nulls are one group."""
    other = np.zeros(table.num_rows - 1, bool)
    for k in keys:
        codes = table.column(k).combine_chunks().dictionary_encode("encode").indices.to_numpy()
        other |= codes[1:] != codes[:-1]
    return other


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that come group by group, as tables of whole groups with each row's group number: the groups that
    end in a batch, the last one held back until it is known to be whole."""
    held: list[pa.Table] = []

    def joined(parts: list[pa.Table]) -> tuple[pa.Table, np.ndarray]:
        table = pa.concat_tables(parts)
        return table, np.concatenate([[0], np.cumsum(_starts(table, keys))])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        before = [held[-1].slice(held[-1].num_rows - 1)] if held else []
        begins = np.flatnonzero(_starts(pa.concat_tables([*before, rows]), keys)) + (0 if held else 1)
        if begins.size:
            last = int(begins[-1])
            yield joined([*held, rows.slice(0, last)] if last else held)
            held, rows = [], rows.slice(last)
        held.append(rows)
    if held:
        yield joined(held)


def _per_chunk(chunked: DataFrame, keys: list[str], names: list[str], fn, order: list[str]) -> DataFrame:
    schema = T.StructType(
        list(chunked.schema.fields) + [T.StructField(name, T.DoubleType(), True) for name in names]
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        for name, values in fn(pdf).items():
            pdf[name] = values
        return pdf

    # grouping equals the chunk window's partitioning: no extra exchange
    return chunked.groupBy(*keys, CHUNK).applyInPandas(run, schema)


def with_macd(
    chunked: DataFrame, keys: list[str], outputs: list[str], order: list[str], keep: list[str] | None = None
) -> DataFrame:
    """Append MACD columns (``ema_12 ema_26 macd macd_signal``) per (key, chunk) to the columns ``keep`` (all).

    The input must be chunked with a halo of at least :func:`ema_halo` rows.
    """
    wanted, groups = list(outputs), [*keys, CHUNK]
    kept = [f for f in chunked.schema.fields if keep is None or f.name in [*groups, "close", *keep]]
    double = [f.name for f in chunked.schema.fields if f.dataType == T.DoubleType() and f.name not in groups]
    schema = T.StructType(kept + [T.StructField(name, T.DoubleType(), True) for name in wanted])

    def run(batches):
        for table, group in whole_groups(batches, groups):
            close = pd.Series(table.column("close").to_numpy().astype("float64", copy=False))
            cols = _macd_columns(close, group)
            for name in wanted:
                table = table.append_column(name, pa.array(cols[name].to_numpy(), pa.float64(), from_pandas=True))
            yield from table.combine_chunks().to_batches()

    dealt = getattr(chunked, "_barspark_partitions", None)
    rows = chunked.withColumns({c: nan_to_null(F.col(c)) for c in double})
    rows = rows if dealt else rows.repartition(*groups)
    rows = rows.sortWithinPartitions(*groups, *[F.col(c).asc_nulls_last() for c in order])
    return rows.select(*[f.name for f in kept]).mapInArrow(run, schema)


def with_pandas_features(chunked: DataFrame, keys: list[str], features: list[Feature], order: list[str]) -> DataFrame:
    """Append every ``kind == "pandas"`` feature, one Arrow-batched pass per (key, chunk)."""
    feats = list(features)

    def fn(pdf):
        out = {f.name: f.series(pdf).to_numpy() for f in feats}
        for f in feats:
            check_lookback(f, pdf, out[f.name])
        return out

    return _per_chunk(chunked, keys, [f.name for f in feats], fn, order)


def check_lookback(feature: Feature, pdf: pd.DataFrame, values: np.ndarray) -> None:
    """A grouped feature may look no further back than it declares, else its values would depend on where a
    ticker is cut.  All rows are computed again with the group cut into ``CHECK_CUTS`` pieces (of one row, in
    groups up to that size), each behind its declared look-back alone, and so is the last row: another value is an error,
    for small tickers as for large ones.  A feature whose excess shows at none of these cuts passes."""
    back = feature.lookback
    if len(pdf) <= back + 1:
        return
    values = np.asarray(values, np.float64)
    finite = np.abs(values[np.isfinite(values)])
    atol = 1e-9 * max(1.0, finite.max() if finite.size else 0.0)
    # a piece that starts within the look-back sees all rows before it: nothing to compare
    size = -(-(len(pdf) - back - 1) // CHECK_CUTS)
    pieces = [(a, min(a + size, len(pdf))) for a in range(back + 1, len(pdf), size)] + [(len(pdf) - 1, len(pdf))]
    for a, b in dict.fromkeys(pieces):
        alone = np.asarray(feature.series(pdf.iloc[a - back : b].reset_index(drop=True)), np.float64)[back:]
        if not np.allclose(alone, values[a:b], rtol=1e-6, atol=atol, equal_nan=True):
            raise ValueError(f"feature {feature.name!r} looks back beyond the {back} rows it declares")
