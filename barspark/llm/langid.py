"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays.

One model per language predicts each character of a word from up to ``ORDER - 1`` characters before it
(a word starts and ends with a space; words are runs of letters, lower-cased).  A model is, for each
order, a sorted array of 64-bit n-gram hashes beside their interpolated log probabilities, and one of
context hashes beside their back-off weights; looking up is a binary search.

A text's score in a language is its cross-entropy: the mean negative log probability per predicted
character.  The lowest wins; the confidence is the winner's share of the languages' likelihoods at one
word's length.  A text is rejected when its best cross-entropy lies above that language's calibrated
limit, set on fold texts that the models did not see, or when it has no letter.

The models learn from a bounded sample: ``sample`` labelled texts a language, drawn by the hash of
their id (whole texts; documented parameter), whose bytes are bounded too, so their size does not grow
with the corpus and they may travel with the tasks.  Scoring covers every row.
"""

from __future__ import annotations

import logging
import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.llm.common import NumberTable, kept_by_worker, sums_by_text, text_slices
from barspark.session import materialize

ORDER = 5
SAMPLE = 400
#: One in ``FOLDS`` sampled texts calibrates the rejection instead of training.
FOLDS = 5
#: Most labels that are learnt without a choice of the caller's (``max_languages``); more are an error.
MAX_LABELS = 2048
_LOG = logging.getLogger(__name__)
#: Largest UTF-8 size of one language's sampled texts, and of all models together (more is an error).
MAX_SAMPLE_BYTES, MAX_MODEL_BYTES = 256 << 20, 512 << 20
#: A language's draw looks at rows whose hash lies in a share of the range that holds about this many times the sample.
DRAW_MARGIN = 4
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
#: Distinct characters the uniform base model spreads over.
ALPHABET = 4096


def letters(text: str) -> list[str]:
    """Lower-cased runs of letters (other numerals that count as word characters are left out)."""
    found = _LETTERS.findall(text.lower())
    return [w for w in (w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in found) if w]


def _all_grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes[k][i] of the k + 1 characters that end at character i of the words (each in its two spaces);
    0 where a word's start cuts them off.  Also each character's place in its word, and its word."""
    code = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(code.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mixed = _mix(code + np.uint64(1))
    rows, now = [], mixed.copy()
    for k in range(order):
        if k:
            # The n-gram's hash folds its characters from the last to the first.
            now = _mix(now * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([np.zeros(min(k, code.size), np.uint64), mixed[:-k]]))
        rows.append(np.where(place >= k, now, np.uint64(0)))
    return np.array(rows), place, word


def _grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """``_all_grams`` that end at predicted characters (all but the opening space), and their words."""
    rows, place, word = _all_grams(words, order)
    told = place > 0
    return rows[:, told], word[told]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def _contexts(words: list[str], order: int) -> np.ndarray:
    """Hashes[k][i]: the k characters before predicted character i (k = 1..order-1), folded as n-grams."""
    code = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    place = np.arange(code.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mixed = _mix(code + np.uint64(1))
    rows, now = [], np.concatenate([np.zeros(1, np.uint64), mixed[:-1]])
    for k in range(1, order):
        if k > 1:
            now = _mix(now * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([np.zeros(min(k, code.size), np.uint64), mixed[:-k]]))
        rows.append(np.where(place >= k, now, np.uint64(0)))
    return np.array(rows)[:, place > 0] if rows else np.zeros((0, int((place > 0).sum())), np.uint64)


@dataclass
class CharModel:
    """Sorted n-gram hashes with log probabilities, and sorted context hashes with log back-off weights, by order."""

    grams: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]

    @staticmethod
    def fit(words: list[str], weights: np.ndarray, order: int = ORDER) -> CharModel:
        """Interpolated Kneser-Ney from distinct words and their counts.

        The highest order (and n-grams that a word's start cuts off) use counts; lower orders count the
        distinct characters seen before.  Each order's discount is n1 / (n1 + 2 n2).
        """
        rows, word = _grams(words, order)
        before = _contexts(words, order)
        told = np.asarray(weights, np.float64)[word]
        model = CharModel([], [], [], [])
        lower: np.ndarray | None = None  # log probability of each occurrence's shorter n-gram
        for k in range(order):
            own, ctx = rows[k], before[k - 1] if k else np.full(rows.shape[1], np.uint64(1))
            there = own != 0
            keys, first, inverse = np.unique(own[there], return_index=True, return_inverse=True)
            plain = np.bincount(inverse, told[there], len(keys))
            if k + 1 < order:
                longer = rows[k + 1][there]
                _, at = np.unique(longer[longer != 0], return_index=True)
                kinds = np.bincount(inverse[longer != 0][at], minlength=len(keys)).astype(float)
                # A word's start is itself a left neighbour: such n-grams keep their counts.
                count = np.where(kinds > 0, kinds, plain)
            else:
                count = plain
            n1, n2 = (count == 1).sum(), (count == 2).sum()
            cut = np.minimum(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.95) or 0.5
            cut = np.minimum(cut, count * 0.95)
            ckeys, cinv = np.unique(ctx[there][first], return_inverse=True)
            total = np.bincount(cinv, count, len(ckeys))
            freed = np.bincount(cinv, cut, len(ckeys)) / np.maximum(total, 1e-300)
            base = np.full(len(keys), 1.0 / ALPHABET) if lower is None else np.exp(lower[there][first])
            p = (count - cut) / total[cinv] + freed[cinv] * base
            model.grams.append(keys)
            model.logp.append(np.log(p))
            model.contexts.append(ckeys)
            model.backoff.append(np.log(freed))
            here = np.full(rows.shape[1], -math.log(ALPHABET)) if lower is None else lower.copy()
            here[there] = np.log(p)[inverse]
            lower = here
        return model

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word (its letters and its end)."""
        if not words:
            return np.zeros(0)
        rows, word = _grams(words, len(self.grams))
        before = _contexts(words, len(self.grams))
        logp = np.full(rows.shape[1], -math.log(ALPHABET))
        for k, (keys, values, ckeys, weights) in enumerate(zip(self.grams, self.logp, self.contexts, self.backoff)):
            ctx = before[k - 1] if k else np.full(rows.shape[1], np.uint64(1))
            # Shorter n-grams first: a known n-gram replaces the estimate, a known context scales it.
            known, at = _find(keys, rows[k])
            seen, cat = _find(ckeys, ctx)
            logp = np.where(known, values[at], np.where(seen, logp + weights[cat], logp)) if len(keys) else logp
        return np.bincount(word, logp, len(words))


def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(x.size, bool), np.zeros(x.size, np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return (keys[at] == x) & (x != 0), at


class MergedModels:
    """The languages' arrays merged by length: one sorted array of hashes, a column per language.

    A string of k characters is looked up once for all languages: as an n-gram (its log probability) and as the
    context of the character after it (its back-off weight).
    """

    def __init__(self, models: list[CharModel], order: int):
        self.order, self.keys, self.logp, self.backoff = order, [], [], []
        for k in range(order):
            held = [m.grams[k] for m in models] + ([m.contexts[k + 1] for m in models] if k + 1 < order else [])
            keys = np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            # the last row stands for an unknown string: no n-gram, no back-off weight
            logp, backoff = np.full((len(keys) + 1, len(models)), np.nan), np.zeros((len(keys) + 1, len(models)))
            for j, m in enumerate(models):
                logp[np.searchsorted(keys, m.grams[k]), j] = m.logp[k]
                if k + 1 < order:
                    backoff[np.searchsorted(keys, m.contexts[k + 1]), j] = m.backoff[k + 1]
            self.keys.append(keys)
            self.logp.append(logp)
            self.backoff.append(backoff)
        self.first = np.array([m.backoff[0][0] if len(m.backoff[0]) else 0.0 for m in models])

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word by language."""
        if not words or not len(self.first):
            return np.zeros((len(words), len(self.first)))
        rows, place, word = _all_grams(words, self.order)
        out = np.full((rows.shape[1], len(self.first)), -math.log(ALPHABET)) + self.first
        for k in range(self.order):
            known, at = _find(self.keys[k], rows[k])
            at = np.where(known, at, len(self.keys[k]))
            value = self.logp[k][at]
            out = np.where(np.isnan(value), out, value)
            if k + 1 < self.order:  # the string before each character, as the context of the next length
                out[1:] += self.backoff[k][at[:-1]] * (place[1:] > k)[:, None]
        out[place == 0] = 0  # the opening space is given
        return np.add.reduceat(out, np.flatnonzero(place == 0))


@dataclass
class LanguageModels:
    """Models by language, with each language's limit on the cross-entropy in nats per character: a text of n
    predicted characters is rejected above ``limits[l, 0] + limits[l, 1] / sqrt(n)`` (short texts vary more)."""

    languages: list[str]
    models: list[CharModel]
    limits: np.ndarray

    def key(self) -> tuple:
        sums = tuple(zlib.crc32(a.tobytes()) for m in self.models for a in (*m.grams, *m.logp))
        return ("langid", tuple(self.languages), hash(sums))

    def table(self) -> NumberTable:
        """A table of words (runs of letters) -> log probability by language, then the characters predicted."""
        merged = MergedModels(self.models, len(self.models[0].grams) if self.models else 0)

        def scores(words: list[str]) -> np.ndarray:
            length = np.fromiter(map(len, words), np.float64, len(words)) + 1
            parts = [merged.score(words[a : a + 20_000]) for a in range(0, len(words), 20_000)]
            return np.column_stack([np.concatenate(parts), length])

        return NumberTable(scores)


def _calibrate(words: list[list[str]], model: CharModel) -> list[float]:
    """Limit on the cross-entropy for long texts and what the spread of single words adds for a text of one
    character.  The limit is that of the same letters in a foreign order: the mean over the held-back texts
    with each word reversed, and never below the worst held-back text and a margin of their spread."""
    flat = [w for ws in words for w in ws]
    if not flat:
        return [math.inf, 0.0]
    sizes = [len(ws) for ws in words]
    length = np.array([len(w) + 1 for w in flat], np.float64)
    nats = -model.score(flat)
    total = sums_by_text(length, sizes)
    mean = sums_by_text(nats, sizes)[total > 0] / total[total > 0]
    word = nats / length
    center = nats.sum() / length.sum()
    spread = math.sqrt(float(((word - center) ** 2 * length).sum() / len(flat)))
    foreign = -model.score([w[::-1] for w in flat]).sum() / length.sum()
    return [float(max(foreign, mean.max() + max(0.5, 4 * mean.std()))), 4 * spread]


def _drawn(keyed: DataFrame, rows: dict[str, int], sample: int, margin: float = DRAW_MARGIN) -> DataFrame:
    """The ``sample`` rows a language with the smallest hash (ties by id and text), numbered ``rn``, as a written table.

    Only rows below a hash limit meet in a language's window: ``rows`` tells how many the language has, so the
    limit lets a small multiple of the sample through, whatever the number of rows or input tasks.  A language whose limit let
    too few through (ids that repeat a lot) is drawn again without one.
    """
    spark = keyed.sparkSession
    order = Window.partitionBy("lang").orderBy("h", "id", "c")

    def draw(limits: dict[str, int]) -> DataFrame:
        below = F.broadcast(spark.createDataFrame(list(limits.items()), "lang string, most bigint"))
        found = keyed.join(below, "lang").filter(F.col("h") <= F.col("most")).drop("most")
        return materialize(found.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= sample), "drawn")

    top = (1 << 63) - 1
    first = draw({k: min(top, math.ceil((1 << 64) * min(1.0, margin * sample / n)) - (1 << 63)) for k, n in rows.items()})
    held = {r.lang: r["count"] for r in first.groupBy("lang").count().collect()}
    short = {k: top for k, n in rows.items() if held.get(k, 0) < min(sample, n)}
    return first.filter(~F.col("lang").isin(list(short))).unionByName(draw(short)) if short else first


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, order: int = ORDER, max_languages: int | None = None,
    max_sample_bytes: int = MAX_SAMPLE_BYTES, max_model_bytes: int = MAX_MODEL_BYTES,
) -> LanguageModels:
    """Models from a bounded sample of labelled texts; rows with a null label or text teach nothing.

    The ``sample`` texts a language with the smallest hash of their id are drawn (ties by id and text), whole.
    Every label is learnt; more than ``MAX_LABELS`` raise ValueError.  With ``max_languages`` the most frequent ones are learnt
    (ties by name) and a warning tells how many labels and rows are not: documents of those go to another language or
    are rejected.  A language whose drawn texts exceed ``max_sample_bytes``, and models that exceed ``max_model_bytes``
    together, raise ValueError.  The n-grams of a language are counted by Spark as (language, word, count) and (fold
    texts).  An empty table gives no languages.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("t"))
    rows = rows.filter("lang is not null and t is not null")
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    labels = {r.lang: r["count"] for r in counted.limit((max_languages or MAX_LABELS) + 1).collect()}
    if max_languages and len(labels) > max_languages:
        more = labels.popitem()[0]
        left = counted.filter(~F.col("lang").isin(list(labels))).agg(F.count("*").alias("labels"), F.sum("count").alias("rows")).first()
        _LOG.warning("%d labels (%r first) on %d rows are not learnt: max_languages is %d", left.labels, more, left.rows, max_languages)
    elif not max_languages and len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels: merge rare ones or choose max_languages")
    if not labels:
        return LanguageModels([], [], np.zeros((0, 2)))
    keyed = rows.select("lang", "id", F.xxhash64("id").alias("h"), F.crc32(F.col("t").cast("binary")).alias("c"), F.octet_length("t").alias("bytes"))
    drawn = _drawn(keyed, labels, sample)
    over = drawn.groupBy("lang").agg(F.sum("bytes").alias("n")).filter(F.col("n") > max_sample_bytes).orderBy("lang").first()
    if over:
        raise ValueError(f"the {sample} sampled texts of {over.lang!r} hold {over.n} bytes: lower sample or raise max_sample_bytes={max_sample_bytes}")
    # (id, crc) pairs of the drawn rows: at most sample * languages of them, so they may be broadcast.
    picked = F.broadcast(drawn.select("lang", "id", "c", (F.pmod("rn", F.lit(FOLDS)) == 0).alias("held")).distinct())
    texts = rows.withColumn("c", F.crc32(F.col("t").cast("binary"))).join(picked, ["lang", "id", "c"]).dropDuplicates(["lang", "id", "c"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in text_slices(batches, "t"):
            tally: dict[tuple, int] = {}
            for lang, doc, held, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), own):
                for w in letters(t):
                    k = (lang, doc if held else None, w)
                    tally[k] = tally.get(k, 0) + 1
            cols = [list(c) for c in zip(*tally)] or [[], [], []]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*cols, list(tally.values())], kinds)], names=["lang", "doc", "w", "n"])

    counted = texts.select("lang", "id", "held", "t").mapInArrow(count, "lang string, doc string, w string, n bigint")
    counted = counted.groupBy("lang", "doc", "w").agg(F.sum("n").alias("n"))

    def build(key, table):
        lang = key[0].as_py()
        doc, w, n = (table.column(c).to_pylist() for c in ("doc", "w", "n"))
        own = sorted((a, b) for d, a, b in zip(doc, w, n) if d is None)
        held: dict[str, list[str]] = {}
        for d, a, b in sorted((x for x in zip(doc, w, n) if x[0] is not None)):
            held.setdefault(d, []).extend([a] * b)
        words, weights = [a for a, _ in own], np.array([b for _, b in own], np.float64)
        if not words:  # too few texts to hold any back: learn from those
            words, weights = [a for ws in held.values() for a in ws], np.ones(sum(map(len, held.values())))
        model = CharModel.fit(words, weights, order)
        raw = [a.tobytes() for part in (model.grams, model.logp, model.contexts, model.backoff) for a in part]
        return pa.table({"lang": [lang], "limits": pa.array([_calibrate(list(held.values()), model)], pa.list_(pa.float64())), "arrays": pa.array([raw], pa.list_(pa.binary()))})

    # One group a language: the distinct words of its sampled texts, at most max_sample_bytes of them.
    found = materialize(counted.groupBy("lang").applyInArrow(build, "lang string, limits array<double>, arrays array<binary>"), "models")
    size = found.agg(F.sum(F.aggregate("arrays", F.lit(0).cast("bigint"), lambda n, a: n + F.octet_length(a)))).first()[0] or 0
    if size > max_model_bytes:
        raise ValueError(f"the models hold {size} bytes: lower sample or order, or raise max_model_bytes={max_model_bytes}")
    found = found.orderBy("lang").collect()
    models = []
    for r in found:
        a = [np.frombuffer(bytes(b), np.uint64 if i // order in (0, 2) else np.float64) for i, b in enumerate(r.arrays)]
        models.append(CharModel(*(a[i * order : (i + 1) * order] for i in range(4))))
    return LanguageModels([r.lang for r in found], models, np.array([r.limits for r in found]).reshape(-1, 2))


_JUDGED = "lang_pred string, score double, cross_entropy double, rejected boolean"


def judge(rows: DataFrame, text_at: int, models: LanguageModels) -> DataFrame:
    """``rows`` with ``lang_pred, score, cross_entropy, rejected`` of the text in column ``text_at``."""
    shared = rows.sparkSession.sparkContext.broadcast(models)
    text = rows.columns[text_at]
    added = T.StructType.fromDDL(_JUDGED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: LanguageModels = shared.value
        table = kept_by_worker(own.key(), own.table)
        for part, texts in text_slices(batches, text):
            words = [letters(t) for t in texts]
            at = table.rows([w for ws in words for w in ws])
            scores = table.matrix[at] if at.size else np.zeros((0, len(own.languages) + 1))
            lang, share, cross, rejected = decide(sums_by_text(scores, [len(ws) for ws in words]), own)
            cols = [pa.array(lang, pa.string()), pa.array(share, pa.float64()), pa.array(cross, pa.float64(), from_pandas=True), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, *added.names])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added.fields]))


def predict(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score, cross_entropy, rejected`` of every row.

    ``score`` in [0, 1] is the winner's share of the languages' likelihoods, tempered to ten characters.
    Null texts, empty ones and texts without a letter are ``und`` with score 0, no cross-entropy,
    rejected.  Equal cross-entropies go to the language first in the alphabet.  Without any learnt
    language every text is ``und`` and only those without a letter are rejected.  Repeated rows give
    repeated rows; an empty table gives none; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("t"))
    return judge(rows, 1, models).drop("t")


def decide(sums: np.ndarray, own: LanguageModels) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, cross-entropy and rejection of texts from their summed word scores."""
    length = sums[:, -1]
    told = length > 0
    if not own.languages:
        n = len(length)
        return [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan), ~told
    mean = -sums[:, :-1] / np.maximum(length, 1)[:, None]
    best = mean.argmin(axis=1)
    low = mean[np.arange(len(mean)), best]
    share = 1 / np.exp(np.clip(10 * (low[:, None] - mean), -700, 0)).sum(axis=1)
    rejected = ~told | (low > own.limits[best, 0] + own.limits[best, 1] / np.sqrt(np.maximum(length, 1)))
    return [own.languages[b] if t else UNKNOWN for b, t in zip(best.tolist(), told.tolist())], np.where(told, share, 0.0), np.where(told, low, np.nan), rejected


def drop_rejected(docs: DataFrame, models: LanguageModels, text_col: str = "text") -> DataFrame:
    """The documents that some language accepts, all columns as they came."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    rows = judge(docs.toDF(*own), docs.columns.index(text_col), models)
    return rows.filter(~F.col("rejected")).select(*own).toDF(*docs.columns)
