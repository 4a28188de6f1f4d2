"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells (source, language, topic).  Raking scales the cells' token weights until
the margins of all three dimensions meet their targets; the scale of a cell is a product of one factor per
category.  Documents are then sampled by calibrated probabilities: a document's chance is its cell's
scale over one rate (1 at most), so the expected tokens of the sample have the target margins but for a
small trimmed share, and as many tokens as that allows.  No category falls short of its own target by more
than ``SHORT`` of it; the margins reached are logged (``margins`` returns them).  The draw is a hash of id and text: repeatable, and blind to the
order of the rows.

Targets are dictionaries given by the caller; categories they don't name (and null) share the class
``OTHER``, whose target is what the named ones leave of 1.  So there are at most
prod(len(targets) + 1) cells whatever the data, and this table is what the driver rakes.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OTHER = "*"
SWEEPS = 200
TOLERANCE = 1e-12
#: Share of the wanted tokens that cells of the largest scales may fall short of.
TRIM = 0.05
#: Share of its own target that any one category may fall short of by the trim.
SHORT = 0.05
#: Largest number of cells the targets may span (a check of the caller's parameter, not of the data).
MAX_CELLS = 100_000

DIMENSIONS = ("source", "lang", "topic")
_LOG = logging.getLogger(__name__)

#: Topics by the style of the whole text; the first rule that holds names it.
TOPICS = ("clauses", "terse", "lines", "plain")


def topic_of(text: Column) -> Column:
    """Topic of a text by its style (a stand-in where documents carry none): ``clauses`` (a comma in 1% of
    its characters), ``terse`` (a full stop in 1.5%), ``lines`` (a line end in 0.3%), else ``plain``;
    null and empty texts are ``plain``."""
    n = F.length(text)

    def per_thousand(char: str) -> Column:
        return F.regexp_count(text, F.lit(f"[{char}]")) * 1000

    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, F.lit("plain"))
        .when(per_thousand(",") >= 10 * n, F.lit("clauses"))
        .when(per_thousand(".") >= 15 * n, F.lit("terse"))
        .when(per_thousand("\n") >= 3 * n, F.lit("lines"))
        .otherwise(F.lit("plain"))
    )


def tokens_of(text: Column) -> Column:
    """Token weight of a text: its UTF-8 bytes over four, rounded up (null: 0).

    A stand-in: languages and topics with more tokens a byte get more real tokens than their target."""
    return F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4).cast("bigint")


#: How documents weigh: a column of counts, a function from the text column to its count, or None for :func:`tokens_of`.
Weights = str | Callable[[Column], Column] | None


def classed(column: Column, targets: dict[str, float]) -> Column:
    return F.when(column.isin(list(targets)), column).otherwise(F.lit(OTHER)) if targets else F.lit(OTHER)


def target_shares(targets: dict[str, float]) -> dict[str, float]:
    """The named shares and what they leave for ``OTHER``; they may not be negative or exceed 1 together."""
    if any(v < 0 for v in targets.values()) or sum(targets.values()) > 1 + 1e-9:
        raise ValueError("target shares must be non-negative and sum to 1 at most")
    return {**targets, OTHER: max(0.0, 1 - sum(targets.values()))}


@dataclass
class Raked:
    """Scale of each present cell, the margins reached, and whether all targets are met."""

    cells: list[tuple[str, ...]]
    tokens: np.ndarray
    scale: np.ndarray
    sweeps: int
    error: float
    targets: list[dict[str, float]] = field(default_factory=list)

    def probability(self, trim: float = TRIM, short: float | None = None) -> np.ndarray:
        """Chance of a document of each cell: its scale over a rate, 1 at most.

        The rate is the smallest scale beyond which cells stand for no more than ``trim`` of the wanted
        tokens.  So all margins are met but for that share, and a rare category with a large
        target (which no sample of distinct documents can meet) doesn't thin out all the others.  With
        ``short`` the rate is also no smaller than it takes for every category to keep all but that share of its
        own wanted tokens: then a rare category does thin out the others, as its target asks.
        """
        if not self.scale.size or not self.scale.max() > 0:
            return np.zeros(self.scale.size)
        order = np.argsort(-self.scale, kind="stable")
        wanted = (self.tokens * self.scale)[order]
        above = np.cumsum(wanted) - wanted  # of the cells with a larger scale
        total = wanted.sum()
        rate = self.scale[order][above <= trim * total][-1] if total > 0 else self.scale.max()
        if short is not None:
            rate = max([rate, *(_least_rate(self.tokens[m], self.scale[m], short) for *_, m in self._categories())])
        return np.minimum(1.0, self.scale / rate) if rate > 0 else np.zeros(self.scale.size)

    def _categories(self) -> list[tuple[int, str, np.ndarray]]:
        """Dimension, name and mask of every category that the cells or the targets name."""
        names = [sorted({c[d] for c in self.cells} | set(t)) for d, t in enumerate(self.targets)]
        return [(d, n, np.array([c[d] == n for c in self.cells], bool)) for d, own in enumerate(names) for n in own]

    def margins(self, p: np.ndarray) -> list[tuple[int, str, float, float, float]]:
        """Dimension, category, target, share of the category in the table and expected share in a sample drawn by ``p``."""
        drawn = self.tokens * p
        return [
            (d, n, self.targets[d].get(n, 0.0), *(float(t[m].sum() / t.sum()) if t.sum() > 0 else 0.0 for t in (self.tokens, drawn)))
            for d, n, m in self._categories()
        ]


def _least_rate(tokens: np.ndarray, scale: np.ndarray, short: float) -> float:
    """Smallest rate at which these cells keep ``1 - short`` of their wanted tokens; a cell keeps tokens * min(rate, scale)."""
    order = np.argsort(scale, kind="stable")
    t, s = tokens[order], scale[order]
    goal = (1 - short) * (t * s).sum()
    if not goal > 0:
        return 0.0
    below = np.cumsum(t * s) - t * s  # of the cells with a smaller scale
    rest = np.cumsum(t[::-1])[::-1]  # tokens of the others
    k = min(int(np.searchsorted(np.maximum.accumulate(below + s * rest), goal)), s.size - 1)
    return float((goal - below[k]) / rest[k]) if rest[k] > 0 else float(s[k])


def rake(cells: list[tuple[str, ...]], tokens: np.ndarray, targets: list[dict[str, float]], sweeps: int = SWEEPS) -> Raked:
    """Iterative proportional fitting of the cells' tokens to the targets of each dimension.

    Targets of categories that hold no tokens can't be met; their share is dealt over the others of
    their dimension in proportion.  Cells without tokens keep scale 0 only if their category's target is 0.
    Sweeps end when every margin is within ``TOLERANCE`` of its target (relative to 1).
    """
    tokens = np.asarray(tokens, np.float64)
    scale = np.ones(tokens.size)
    total = tokens.sum()
    if not tokens.size or total <= 0:
        return Raked(cells, tokens, scale, 0, 0.0, targets)
    keys, wanted = [], []
    for d, target in enumerate(targets):
        names = sorted({c[d] for c in cells})
        index = np.array([names.index(c[d]) for c in cells])
        held = np.bincount(index, tokens, len(names)) > 0
        want = np.array([target.get(n, 0.0) for n in names]) * held
        if want.sum() <= 0:
            raise ValueError(f"no target of dimension {d} names a category that holds tokens")
        keys.append(index)
        wanted.append(want / want.sum())
    done, error = 0, np.inf
    while done < sweeps and error > TOLERANCE:
        for index, want in zip(keys, wanted):
            have = np.bincount(index, tokens * scale, len(want))
            now = have.sum()
            factor = np.divide(want * now, have, out=np.zeros(len(want)), where=have > 0)
            scale = scale * factor[index]
            if not (tokens * scale).sum() > 0:
                raise ValueError("the targets exclude every cell")
        weight = tokens * scale
        error = max(float(np.abs(np.bincount(i, weight, len(w)) / weight.sum() - w).max()) for i, w in zip(keys, wanted))
        done += 1
    return Raked(cells, tokens, scale / scale.max(), done, error, targets)


def cell_weights(docs: DataFrame, columns: list[Column], targets: list[dict[str, float]], tokens: Column) -> Raked:
    """Token sums by cell (one distributed aggregate), raked to the targets."""
    shares = [target_shares(t) for t in targets]
    if np.prod([len(s) for s in shares]) > MAX_CELLS:
        raise ValueError(f"the targets span more than {MAX_CELLS} cells")
    keys = [classed(c, t).alias(f"k{i}") for i, (c, t) in enumerate(zip(columns, targets))]
    rows = docs.select(*keys, tokens.alias("tokens")).groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.sum("tokens").alias("tokens"))
    found = sorted((tuple(r)[:-1], r.tokens or 0) for r in rows.collect())
    return rake([c for c, _ in found], np.array([n for _, n in found], np.float64), shares)


def with_probability(docs: DataFrame, columns: list[Column], targets: list[dict[str, float]], raked: Raked, draw: list[Column], prefix: str = "_mix_") -> DataFrame:
    """``docs`` with ``<prefix>k0..``, ``<prefix>p`` (probability) and ``<prefix>u`` (uniform draw in [0, 1)).

    The cells are a broadcast side of the join: their number is bounded by the targets.
    """
    spark = docs.sparkSession
    names = [f"{prefix}k{i}" for i in range(len(columns))]
    fields = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(f"{prefix}c", T.DoubleType())])
    cells = spark.createDataFrame([(*c, p) for c, p in zip(raked.cells, raked.probability(TRIM, SHORT).tolist())], fields)
    text = F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("")) for c in draw])
    uniform = F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    keyed = docs.select("*", *[classed(c, t).alias(n) for n, c, t in zip(names, columns, targets)], uniform.alias(f"{prefix}u"))
    return keyed.join(F.broadcast(cells), names, "left").withColumn(f"{prefix}p", F.coalesce(f"{prefix}c", F.lit(0.0)))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]], source: str = "source", lang: str = "lang", text: str = "text", id_col: str = "doc_id", tokens: Weights = None, topic: str | None = None) -> DataFrame:
    """Every document with its cell, token weight, probability and whether it is drawn, and nothing dropped.

    ``targets`` has ``source``, ``lang`` and ``topic`` dictionaries.  ``tokens`` names a column of token counts
    (null: 0) or makes one from the text; without it the weight is :func:`tokens_of` the text, which counts bytes.  ``topic``
    names a column of topics; without it they are :func:`topic_of` the text.  Columns: ``id, source, lang, topic,
    tokens, probability, kept``.  Null source, language or given topic counts as ``OTHER``; documents without text
    weigh 0 tokens and are drawn by their cell's chance.  Repeated rows share one draw; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), *_inputs(source, lang, text, tokens, topic))
    columns, want, raked = _plan(rows, targets)
    out = with_probability(rows, columns, want, raked, [F.col("id"), F.md5(F.coalesce("t", F.lit("")))])
    return out.select(
        "id", F.col("_mix_k0").alias("source"), F.col("_mix_k1").alias("lang"), F.col("_mix_k2").alias("topic"), F.col("n").alias("tokens"),
        F.col("_mix_p").alias("probability"), (F.col("_mix_u") < F.col("_mix_p")).alias("kept"),
    )


def _inputs(source: str, lang: str, text: str, tokens: Weights, topic: str | None) -> list[Column]:
    """Source ``s``, language ``l``, text ``t``, topic ``o`` and weight ``n`` of a document."""
    t = F.col(text).cast("string")
    if tokens is None:
        weight = tokens_of(t)
    else:
        weight = F.coalesce((F.col(tokens) if isinstance(tokens, str) else tokens(t)).cast("bigint"), F.lit(0))
    about = topic_of(t) if topic is None else F.col(topic).cast("string")
    return [F.col(source).cast("string").alias("s"), F.col(lang).cast("string").alias("l"), t.alias("t"), about.alias("o"), weight.alias("n")]


def _plan(rows: DataFrame, targets: dict[str, dict[str, float]]) -> tuple[list[Column], list[dict[str, float]], Raked]:
    columns = [F.col("s"), F.col("l"), F.col("o")]
    want = [targets.get(k, {}) for k in DIMENSIONS]
    raked = cell_weights(rows, columns, want, F.col("n"))
    _report(raked)
    return columns, want, raked


def _report(raked: Raked) -> None:
    """Logs the margins reached; a target missed by more than ``SHORT`` of it, or raking that did not settle, is a warning.

    That no category is left for ``OTHER`` is none: its share goes to the named ones."""
    if raked.error > TOLERANCE:
        _LOG.warning("raking: margins off by up to %.3g after %d sweeps: the targets contradict each other or need more sweeps", raked.error, raked.sweeps)
    for d, name, target, held, reached in raked.margins(raked.probability(TRIM, SHORT)):
        missed = raked.cells and reached < (1 - SHORT) * target - 1e-9 and not (name == OTHER and held == 0)
        level = logging.WARNING if missed else logging.INFO
        _LOG.log(level, "mix: %s %r: target %.4f, in the table %.4f, reached %.4f", DIMENSIONS[d], name, target, held, reached)


def margins(docs: DataFrame, targets: dict[str, dict[str, float]], source: str = "source", lang: str = "lang", text: str = "text", tokens: Weights = None, topic: str | None = None) -> DataFrame:
    """Target, share in the table and expected share in the sample of every category, and the raking's error.

    Columns: ``dimension, category, target, held, reached, error``; one row a category, present or only
    named.  A category without tokens can't be met: it has ``reached`` 0, and the others share its target.
    """
    rows = docs.select(*_inputs(source, lang, text, tokens, topic))
    raked = _plan(rows, targets)[2]
    found = [(DIMENSIONS[d], *rest, raked.error) for d, *rest in raked.margins(raked.probability(TRIM, SHORT))]
    return docs.sparkSession.createDataFrame(found, "dimension string, category string, target double, held double, reached double, error double")


def sample(docs: DataFrame, targets: dict[str, dict[str, float]], source: str = "source", lang: str = "lang", text: str = "text", id_col: str = "doc_id", tokens: Weights = None, topic: str | None = None) -> DataFrame:
    """The drawn documents, all columns as they came; arguments, nulls, empty texts and repeated rows as in :func:`mix`.

    The weights are needed for raking alone: the pass that draws doesn't compute them again."""
    own = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c: own[docs.columns.index(c)] for c in (source, lang, text, id_col, tokens, topic) if isinstance(c, str)}
    weights = at[tokens] if isinstance(tokens, str) else tokens
    rows = docs.toDF(*own).select("*", *_inputs(at[source], at[lang], at[text], weights, at.get(topic)))
    columns, want, raked = _plan(rows, targets)
    out = with_probability(rows, columns, want, raked, [F.col(at[id_col]), F.md5(F.coalesce("t", F.lit("")))])
    return out.filter(F.col("_mix_u") < F.col("_mix_p")).select(*own).toDF(*docs.columns)
