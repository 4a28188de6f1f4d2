"""SimHash components, covering masks, connected components and nearest neighbours against brute force."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barspark.llm import ann, queries, simhash
from barspark.llm.components import connected_components

from .conftest import edge_rows

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(A_Z))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items, linked):
    up = list(range(len(items)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(items)), 2):
        if linked(items[i], items[j]):
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def test_fingerprints_by_definition():
    for _, text, *_ in edge_rows():
        if text is None or len(text) < 50_000:
            assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def test_masks_cover_every_set_of_differing_bits():
    masks = simhash.covering_masks(list(range(64)))
    assert len(masks) == 15
    for bits in itertools.combinations(range(0, 64), 3):
        gone = sum(1 << b for b in bits)
        assert any(not m & gone for m in masks)
    for mask in masks[:3]:
        finer = simhash.second_masks(mask)
        free = [b for b in range(64) if not mask >> b & 1]
        assert all(m & mask == mask for m in finer)
        assert all(64 - m.bit_count() <= 18 for m in finer)  # bounds what a bucket can hold
        for bits in itertools.combinations(free, 3):
            assert any(not m & sum(1 << b for b in bits) for m in finer)


def clouds(seed: int, centers: int, each: int) -> list[int]:
    rng = random.Random(seed)
    out = set()
    for _ in range(centers):
        x = rng.getrandbits(64)
        for _ in range(each):
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("direct", [2048, 4])
def test_links_connect_what_brute_force_connects(spark, direct):
    values = clouds(3, 12, 40)
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp bigint")
    found = {r.node: r.root for r in connected_components(simhash.fingerprint_links(frame, 3, direct)).collect()}
    want = plain_components(values, lambda a, b: (a ^ b).bit_count() <= 3)
    groups: dict = {}
    for v, w in zip(values, want):
        groups.setdefault(found.get(simhash._signed(v), simhash._signed(v)), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_components_of_a_long_path_and_of_nothing(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = connected_components(edges.unionByName(spark.createDataFrame([(100, 101), (101, 101)], "a bigint, b bigint")))
    got = {r.node: r.root for r in out.collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(edges.limit(0)).count() == 0


def near_rows():
    """Awkward documents, and long ones with one word changed."""
    rng = random.Random(9)
    long = [f"w{rng.randrange(5000)}" for _ in range(3000)]
    rows = [(r[0], r[1]) for r in edge_rows() if r[1] is None or len(r[1]) < 50_000]
    for k in range(12):
        own = list(long)
        own[200 * k] = f"changed{k}"
        rows.append((500 - k, " ".join(own)))
    return rows


def test_near_duplicates_equal_brute_force(spark, nothing):
    rows = near_rows()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    out = simhash.near_duplicates(frame.repartition(4), direct=3).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    low = {r: min((i for (i, _), s in zip(rows, roots) if s == r and i is not None), default=None) for r in roots}
    want = sorted(((i, simhash._signed(p), low[r]) for (i, _), p, r in zip(rows, prints, roots)), key=str)
    assert sorted(((r.id, r.fp, r.component_id) for r in out), key=str) == want
    assert len({r for r, (i, _) in zip(roots, rows) if i and i > 488}) < 12  # some copies are linked
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((low[r] for r in set(roots)), key=str)
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.drop_near_duplicates(nothing).count() == 0


def test_groups_of_hot_fingerprints_stay_in_their_tasks(spark):
    """A fingerprint with a third of all groups adds no rows to any task of the look-up join."""
    local = spark.range(3000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("fp"), F.array(F.struct("id", F.col("id").alias("tag"))).alias("members")
    )
    named = local.groupBy("fp").agg(F.count("*").alias("groups")).withColumn("root", F.col("fp")).withColumn("component_id", F.col("fp"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = simhash._with_names(local, named).withColumn("at", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("at").count().collect()]
        rows = out.select("fp", "root", "component_id", F.element_at("members", 1)["id"].alias("id")).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted(r.id for r in rows) == list(range(3000))
    assert all(r.fp == r.root == r.component_id == (7 if r.id % 3 == 0 else r.id) for r in rows)
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_hex_fingerprint(spark):
    frame = spark.createDataFrame([(-1,), (0,), (255,)], "fp bigint")
    assert [r[0] for r in frame.select(simhash.hex_fingerprint(F.col("fp"))).collect()] == ["f" * 16, "0" * 16, "00000000000000ff"]


# --- nearest neighbours ------------------------------------------------------------------------------------


def brute(rows, is_query, k=5):
    usable = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, v in usable:
        if is_query(i):
            scores = [(float(ann.cosines(v, w[None, :])[0]), j) for j, w in usable if j != i]
            out[i] = sorted(scores, key=lambda x: (-x[0], x[1]))[:k]
    return out


def vectors(n: int, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(8, 24))
    return [(i, (centers[i % 8] + 0.5 * rng.normal(size=24)).tolist()) for i in range(n)]


def test_chi2_quantile():
    assert ann.chi2_quantile(0.99, 8) == pytest.approx(20.0902, abs=1e-3)
    assert ann.chi2_quantile(0.5, 2) == pytest.approx(1.3863, abs=1e-3)


def test_exact_when_the_test_never_stops_early(spark):
    rows = vectors(400)
    rows += [(1000 + j, rows[0][1]) for j in range(9)]  # equal vectors: ties go to the smaller id
    odd = [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [None] + [1.0] * 23), (2004, [float("nan")] * 24), (2005, [float("inf")] * 24), (None, [1.0] * 24)]
    frame = spark.createDataFrame(rows + odd + rows[:3], "vec_id bigint, embedding array<double>").withColumn("rep", F.lit(0)).withColumn("ids", F.lit("x"))
    out = ann.nearest(frame, lambda i: i % 40 == 0, confidence=1 - 1e-12, group_rows=60).collect()
    want = brute(rows, lambda i: i % 40 == 0)
    got: dict = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    assert all(a == pytest.approx(b, abs=1e-12) for q in got for (a, _), (b, _) in zip(got[q], want[q]))


def test_few_candidates_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.5])], "vec_id bigint, embedding array<double>")
    out = ann.nearest(frame, lambda i: i == 0).collect()
    assert [(r.rank, r.vec_id) for r in sorted(out, key=lambda r: r.rank)] == [(1, 2), (2, 1)]  # a shorter vector counts as padded
    assert ann.nearest(frame.limit(0), lambda i: i == 0).count() == 0
    assert ann.nearest(frame.limit(1), lambda i: i == 0).count() == 0


def test_recall_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 50 == 0)
    got: dict = {}
    for r in queries.op6_projected_neighbours(spark, sf_dir).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & {i for _, i in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def recall_and_share(out, ids, v, k=5):
    """Recall of the found rows against brute force, and the largest and mean share of the points verified."""
    u = ann.unit(v)
    got: dict = {}
    share = {}
    for r in out:
        got.setdefault(r.query_id, set()).add(r.vec_id)
        share[r.query_id] = r.verified / len(v)
    hits = 0
    for q in got:
        score = u @ u[q]
        score[q] = -2
        hits += len(got[q] & set(ids[np.argpartition(-score, k)[:k]].tolist()))
    return hits / (k * len(got)), float(np.mean(list(share.values()))), len(got)


@pytest.mark.parametrize("n, step", [(2000, 50), (50_000, 500)])
def test_the_stopping_test_stops_on_clustered_vectors(spark, n, step):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(40, 64))[rng.integers(0, 40, n)] + 0.3 * rng.normal(size=(n, 64))
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id bigint, embedding array<double>")
    out = ann.nearest(frame, lambda i: i % step == 0, group_rows=2048 if n > 2000 else 256).collect()
    recall, share, queries_found = recall_and_share(out, np.arange(n), v)
    assert queries_found == n // step
    assert recall >= 0.9 and share < 0.3


def test_rounds_blocks_and_salts_give_the_exact_result(spark):
    rows = vectors(300, 4)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    # 4 cells of 8 blocks, and every query in a task of its own copy of the group
    out = ann.nearest(frame, lambda i: i % 30 == 0, confidence=1 - 1e-12, group_rows=10, max_cells=4, query_rows=1).collect()
    want = brute(rows, lambda i: i % 30 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in out) == sorted((q, k + 1, i) for q, best in want.items() for k, (_, i) in enumerate(best))


def test_one_id_with_two_vectors_is_two_points(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), lambda i: i == 0, k=1).collect()
    assert sorted(r.vec_id for r in out) == [1, 2]
