"""Product codes by GNAT, fill-in-middle frames and the quality trees, each against a plain computation."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barspark.llm import fim, oracles, quality, queries, vector_codes
from oracle_check import canon, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_gnat_codes", "op12_fim_frames"])
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    want = duck(SMALL).execute(queries.ORACLES[name]).df()
    assert len(got) and sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


# --- product codes --------------------------------------------------------------------------------

small_ints = st.lists(st.tuples(*[st.integers(-6, 6)] * 3), min_size=1, max_size=90)


@given(small_ints, small_ints, st.integers(2, 8), st.integers(1, 8))
@settings(max_examples=150, deadline=None)
def test_tree_finds_the_first_of_the_nearest_entries(entries, queries_, degree, leaf):
    e, q = np.array(entries, np.int64), np.array(queries_, np.int64)
    index, d2 = vector_codes.Gnat(e, degree, leaf).search(q)
    all_d2 = ((q[:, None] - e[None]) ** 2).sum(axis=2)
    assert (index == all_d2.argmin(axis=1)).all() and (d2 == all_d2.min(axis=1)).all()


def test_tree_is_exact_where_rounded_distances_tie():
    big = 2**27
    e = np.array([[big, big], [big, big - 1], [-big, big], [0, 0]] + [[big - k, k] for k in range(60)], np.int64)
    q = e[:, ::-1].copy() + 1
    index, d2 = vector_codes.Gnat(e, 4, 2).search(q)
    exact = [[int(sum((int(a) - int(b)) ** 2 for a, b in zip(x, y))) for y in e] for x in q]
    assert index.tolist() == [row.index(min(row)) for row in exact] and d2.tolist() == [min(row) for row in exact]


def test_tree_eliminates_subtrees():
    rng = np.random.default_rng(3)
    e = rng.integers(-100, 100, (64, 4))
    tree = vector_codes.Gnat(e)
    tree.search(rng.integers(-100, 100, (2000, 4)))
    assert tree.visited < 0.6 * 2000 * 64


def plain_codes(rows, parts, entries, rounds, scale):
    """(id, label, code, error) and codebooks by Python integers."""
    kept = [(i, lab, [int(np.floor(scale * x)) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept = [r for r in kept if len(r[2]) == 8]
    w = 8 // parts
    cut = [[r[2][w * p : w * p + w] for p in range(parts)] for r in kept]
    seeds = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, rows_vector(kept[k][2])))[:entries]
    books = [[cut[k][p] for k in seeds] for p in range(parts)]

    def near(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = [near(p, c[p])[0] for c in cut]
            new.append([[sum(c[p][j] for c, o in zip(cut, own) if o == e) // own.count(e) for j in range(w)] if e in own else books[p][e] for e in range(len(books[p]))])
        books = new
    out = [(i, lab, "".join(f"{near(p, c[p])[0]:02x}" for p in range(parts)), sum(near(p, c[p])[1] for p in range(parts))) for (i, lab, _), c in zip(kept, cut)]
    return out, books


def rows_vector(v):
    return tuple(v)


def awkward_vectors():
    rng = np.random.default_rng(9)
    rows = [(i, [None, 1, 2][i % 3], np.round(rng.normal(size=8), 2).tolist()) for i in range(120)]
    return rows + [
        (5, 1, rows[5][2]), (5, 2, rows[6][2]), (None, 7, rows[7][2]), (200, None, rows[8][2]), (201, 1, None), (202, 1, [None] + [0.0] * 7),
        (203, 2, [float("nan")] + [0.0] * 7), (204, 2, [float("-inf")] + [0.0] * 7), (205, 9, [-0.0] * 8), (206, 9, [-1e-9] * 8), (207, 4, []), (208, 4, [1.0, 2.0]),
    ]


def test_codes_on_awkward_vectors(spark):
    rows = awkward_vectors()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, label int, embedding array<double>, code string, error string").repartition(5)
    out, books = vector_codes.compress(df, 4, 16, 2, 256)
    want, want_books = plain_codes(rows, 4, 16, 2, 256)
    assert books.entries.tolist() == want_books
    labels = {}
    for _, lab, _, e in want:
        labels[lab] = labels.get(lab, 0) + e
    want_rows = [(*r, labels[r[1]]) for r in want] + [(207, 4, None, None, None), (208, 4, None, None, None)]
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want_rows, key=str)
    assert np.abs(books.decode(want[0][2]) * 256 - np.floor(256 * np.array(rows[0][2]))).max() < 700


def test_codes_of_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert vector_codes.compress(spark.createDataFrame([], schema), 4, 16, 2, 256)[0].count() == 0
    out, books = vector_codes.compress(spark.createDataFrame([(1, [1.0] * 8, None), (2, [2.0] * 8, None)], schema), 4, 16, 2, 256)
    assert sorted(r.code for r in out.collect()) == ["00000000", "01010101"] and books.entries.shape == (4, 2, 2)
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 6, None)], schema), 4, 16, 2, 256)


def test_label_sums_beside_a_hot_label(spark):
    coded = spark.range(40_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).cast("int").alias("label"), F.lit("00").alias("code"), (F.col("id") % 7).alias("error"))
    out = vector_codes.with_label_error(coded).collect()
    assert len(out) == 40_000
    hot = sum(i % 7 for i in range(40_000) if i % 3 == 0)
    assert all(r.label_error == (hot if r.label is None else r.error) for r in out)


# --- fill in the middle ---------------------------------------------------------------------------


def plain_fim(i, t, seed=7, rate=100, spm=50):
    t = t or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(lines)
    h = [int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return i, n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < spm:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_fim_on_awkward_documents(spark, edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    hostile = [(300 + k, t) for k, t in enumerate(["\n", "\n\n\n", "a\n", "a", "\r\nb\r", "<P", "x<M>y", "<\nP>", "é\n😀\nz", "\x00\n\x00", "P>\n<S\n>" * 50])]
    hostile += [(400 + k, ("line %d\n" % k) * 40_000 + "😀" * 100_000) for k in range(3)] + [(500 + k, "ü" * 300_000 + "\n" * k) for k in range(3)]
    df = edge.select("doc_id", "text", "id", "n", "t").unionByName(spark.createDataFrame(hostile, "doc_id bigint, text string"), allowMissingColumns=True)
    want = [plain_fim(i, t) for i, t in rows + hostile]
    stored = fim.store(df.repartition(4))
    got = fim.digests(fim.transform(stored, 7)).collect()
    restored = {}
    for (i, t), w in zip(rows + hostile, want):
        restored.setdefault((i, w[5]), sha(t or ""))
    assert sorted(((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in got), key=str) == sorted(
        ((*w[:5], sha(w[5]), restored[w[0], w[5]]) for w in want), key=str
    )
    whole = fim.texts(fim.transform(stored, 7, rate=40, spm=80)).collect()
    assert sorted(((r.id, r.form, r.output) for r in whole), key=str) == sorted(((w[0], w[2], w[5]) for w in (plain_fim(i, t, 7, 40, 80) for i, t in rows + hostile)), key=str)
    assert fim.digests(fim.transform(fim.store(nothing), 7)).count() == 0


@given(st.text(alphabet="ab\né😀<P>", max_size=60), st.integers(0, 70), st.integers(0, 70), st.sampled_from(["psm", "spm"]), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_cuts_of_many_small_frames(text, h1, h2, form, size):
    if any(m in text for m in ("<P>", "<S>", "<M>")) or not text:
        return
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    old, fim.FRAME_BYTES = fim.FRAME_BYTES, max(size, 3)
    try:
        w = fim.Writer()
        w.text(text.encode())
        source = w.close()
        assert source.units(not text.endswith("\n")) == n
        out, prefix, middle = fim.cut(source, n, a, b, form, w)
    finally:
        fim.FRAME_BYTES = old
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    want = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    assert b"".join(out.stream()).decode() == want and (prefix, middle) == (len(p), len(m))
    assert b"".join(fim.restored(out, form)).decode() == text


def test_only_cut_frames_are_opened(monkeypatch):
    w = fim.Writer()
    w.text(b"some line of text\n" * 100_000)
    source, opened = w.close(), []
    raw = fim.Frames.raw
    monkeypatch.setattr(fim.Frames, "raw", lambda self, k: opened.append(k) or raw(self, k))
    fim.cut(source, 100_000, 20_011, 70_001, "psm", w)
    assert len(source) > 10 and len(opened) == 2


# --- quality ----------------------------------------------------------------------------------------


def auc(score, y):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(len(score))
    for v in np.unique(score):
        ranks[score == v] = ranks[score == v].mean()
    pos = y == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op13_boosted_quality(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = out.join(labels, "doc_id").toPandas()
    rest = got[got.held_out]
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count() and got.score.between(0, 1).all()
    assert len(rest) > 50 and auc(rest.score.to_numpy(), rest.quality.to_numpy()) > 0.95
    assert (rest.predicted == rest.quality).mean() > 0.9
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_scores_of_awkward_documents(spark, edge, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (3, 0), (3, 1), (100, 1), (999, 0)], "doc_id bigint, quality int")
    model = quality.fit(edge, labels)
    out = quality.score(edge, model).collect()
    assert len(out) == edge.count() and all(0 < r.score < 1 for r in out)
    texts = {(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()}
    want = {(i, round(float(model.probability(quality._matrix([t or ""]))[0]), 12)) for i, t in texts}
    assert {(r.id, round(r.score, 12)) for r in out} == want
    assert quality.score(nothing, model).count() == 0
    blank = quality.fit(nothing, labels)
    assert {r.score for r in quality.score(edge, blank).collect()} == {0.5}
    one = quality.fit(edge, labels.where("quality = 1"))
    assert not len(one.roots) and {r.score > 0.5 for r in quality.score(edge, one).collect()} == {True}


def plain_tree_margin(m, x):
    out = m.base
    for root in m.roots:
        at = root
        for _ in range(m.depth):
            at = m.child[at] + (x[m.feature[at]] > m.threshold[at])
        out += m.value[at]
    return out


def plain_first_split(x, y, bins):
    """Best first split by trying every edge of every column on the rows themselves."""
    p = (y.sum() + 0.5) / (len(y) + 1)
    p = p / 1.0
    base = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    q = 1 / (1 + np.exp(-base))
    g, h = q - y, np.full(len(y), q * (1 - q))
    best = None
    for f, edges in enumerate(quality.bin_edges(x, bins)):
        for e in edges:
            left = x[:, f] <= e
            hl, hr = h[left].sum(), h[~left].sum()
            if min(hl, hr) < quality.LEAST_HESSIAN:
                continue
            gain = g[left].sum() ** 2 / (hl + quality.RIDGE) + g[~left].sum() ** 2 / (hr + quality.RIDGE)
            if best is None or gain > best[0] + 1e-9:
                best = (gain, f, e)
    return best[1:]


def test_trees_against_plain_loops():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(400, 5)), 1)
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    m = quality.fit_trees(x, y, trees=7, depth=3)
    assert np.allclose(m.margin(x), [plain_tree_margin(m, r) for r in x])
    assert (m.feature[0], m.threshold[0]) == plain_first_split(x, y, quality.BINS)
    deep = quality.fit_trees(x, y, trees=60, depth=3)
    assert ((deep.margin(x) > 0) == (y == 1)).mean() > 0.97


def test_statistics_by_hand():
    own = dict(zip(quality.STATISTICS, quality.statistics("One one, one one\n12 | ü")))
    assert own["distinct_words"] == 6 / 7 and own["repeated_words"] == 1 / 6 and own["words_without_letters"] == 2 / 7
    assert own["distinct_lines"] == 1 and own["longest_line"] == 16 / 23 and own["digits"] == 2 / 24 and own["beyond_ascii"] == 1 / 24
    assert quality.statistics("") == [0.0] * len(quality.STATISTICS)
    assert len(quality.statistics(" \n\t")) == len(quality.STATISTICS) == len(quality.statistics("a b " * 100_000))


def test_label_draw_is_bounded(spark):
    labels = spark.range(50_000).select(F.col("id"), (F.col("id") % 2).cast("int").alias("label"))
    assert 800 < quality._drawn(labels, 1000).count() < 1100
    assert quality._drawn(labels, 50_000).count() == 50_000


def test_oracles_name_their_columns():
    assert "label_error" in oracles.gnat_codes(16, 64, 2, 256) and "restored_sha256" in oracles.fim_frames(7)
