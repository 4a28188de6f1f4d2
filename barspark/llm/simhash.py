"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A 64-bit fingerprint takes each bit by majority over the hashes of a text's word shingles.  Two texts
are linked when their fingerprints differ in at most ``radius`` bits; linked texts form components.

*Covering masks* (radius r): bit i gets a label m(i) in 1..2^(r+1)-1, and table v (1..2^(r+1)-1) keeps
the bits with odd parity of m(i) & v.  The labels of any r differing bits span at most r of the r+1
dimensions, so some v is orthogonal to all of them: that table's mask holds none of the differing bits
and the pair collides there.  No pair within the radius is missed, whatever the data.

Only distinct fingerprints enter the tables.  A bucket of up to ``direct`` of them is searched at once.
A larger bucket is covered again by masks over the bits its first mask left free; what then shares a
bucket differs in 13 to 16 bits only, so at most 2^16 distinct fingerprints can meet: a proven
bound for a task, with no cap and no lost pair.  A bucket emits a spanning forest of its links, never
its pairs; components are joined afterwards.  Names of hot fingerprints are broadcast to their rows
(fewer than 1 / ``HOT_SHARE`` of them), so no task gathers a hot fingerprint's documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspark.llm.common import forget_kept, orderable, text_slices
from barspark.llm.components import connected_components
from barspark.session import materialize

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Distinct fingerprints of a bucket that are compared directly; larger buckets are covered again.
DIRECT = 2048
BITS = 64
#: Share of all local groups from which a fingerprint counts as hot.
HOT_SHARE = 1e-4


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text: ASCII lower case, words between ASCII white space, word shingles, XXH64.

    Fewer words than a shingle make one shingle of all; no word gives 0.  A bit is 1 when it is set
    in over half of the shingles' hashes (repeats count).
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    space = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate([[0], space + 1])
    ends = np.append(space, len(line))
    k = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(words) - k
    for a in range(0, n, 1 << 15):  # a long text is counted in runs
        b = min(n, a + (1 << 15))
        h = np.array([digest(line[s:e], seed) for s, e in zip(starts[a:b].tolist(), ends[a + k : b + k].tolist())], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bit positions such that any ``radius`` of them are absent from some mask."""
    tables = (1 << (radius + 1)) - 1
    label = {b: j % tables + 1 for j, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (label[b] & v).bit_count() % 2) for v in range(1, tables + 1)]


def second_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks that keep all of ``mask`` and cover the bits it leaves free."""
    return [mask | m for m in covering_masks([b for b in range(BITS) if not mask >> b & 1], radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest (index pairs) of distinct uint64 values linked within ``radius`` bits."""
    left, out = np.arange(values.size), []
    while left.size > 1:
        front, left = [int(left[0])], left[1:]
        while front and left.size:
            i = front.pop()
            near = np.bitwise_count(values[left] ^ values[i]) <= radius
            if near.any():
                found = left[near].tolist()
                out += [(i, j) for j in found]
                front += found
                left = left[~near]
    return out


class _Forest:
    """Union-find over int keys that hands out (node, root) pairs; emptied when it grows large."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.setdefault(root, root)) != root:
            root = p
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def pairs(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self.up) if (r := self.find(x)) != x]


_FOREST_NODES = 300_000


def _bucket_links(radius: int):
    """Buckets (arrays of distinct fingerprints) -> edges; one task's buckets share a bounded forest."""

    def batch_of(forest: _Forest) -> pa.RecordBatch:
        pairs = forest.pairs()
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        for batch in batches:
            lists = batch.column(0)
            offsets = np.asarray(lists.offsets).astype(np.int64)
            flat = np.asarray(lists.values).astype(np.int64)
            sizes = np.diff(offsets)
            two = offsets[:-1][sizes == 2]
            if two.size:
                x, y = flat[two], flat[two + 1]
                near = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
                for a, b in zip(x[near].tolist(), y[near].tolist()):
                    forest.join(a, b)
            for a, n in zip(offsets[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                own = flat[a : a + n]
                for i, j in links(own.view(np.uint64), radius):
                    forest.join(int(own[i]), int(own[j]))
                if len(forest.up) > _FOREST_NODES:
                    yield batch_of(forest)
                    forest = _Forest()
        yield batch_of(forest)

    return run


def fingerprint_links(fingerprints: DataFrame, radius: int = RADIUS, direct: int = DIRECT) -> DataFrame:
    """Edges ``a, b`` that connect exactly the ``fp`` (distinct bigint) linked within ``radius`` bits."""
    masks = covering_masks(list(range(BITS)), radius)
    fp = F.col("fp")
    tables = F.array(*[fp.bitwiseAND(F.lit(_signed(m))) for m in masks])
    rows = fingerprints.select("fp", F.posexplode(tables).alias("v", "key"))
    sizes = rows.groupBy("v", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialize(rows.join(sizes, ["v", "key"]), "met")
    near = met.filter(F.col("n") <= direct).groupBy("v", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
    again = F.array(*[F.array(*[F.lit(_signed(m)) for m in second_masks(mask, radius)]) for mask in masks])
    finer = F.transform(F.element_at(again, F.col("v") + 1), lambda m: F.col("fp").bitwiseAND(m))
    far = met.filter(F.col("n") > direct).select("fp", "v", F.posexplode(finer).alias("u", "key2"))
    far = far.groupBy("v", "u", "key2").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps")
    return near.unionByName(far).mapInArrow(_bucket_links(radius), "a bigint, b bigint")


def _local_fingerprints(shingle: int, seed: int):
    kind = pa.list_(pa.struct([("id", pa.int64()), ("tag", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for part, texts in text_slices(batches, "t"):
            groups: dict[int, list] = {}
            known: dict[str, int] = {}  # equal texts of a slice are hashed once
            for i, tag, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                if t not in known:
                    known[t] = _signed(fingerprint(t, shingle, seed))
                groups.setdefault(known[t], []).append({"id": i, "tag": tag})
            yield pa.RecordBatch.from_arrays([pa.array(list(groups), pa.int64()), pa.array(list(groups.values()), kind)], names=["fp", "members"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, direct: int = DIRECT) -> DataFrame:
    """``id, tag, fp, component_id, root`` for every row; the component id is the smallest id reachable.

    ``fp`` is the fingerprint as a signed 64-bit value, ``tag`` the text's xxhash64 (it tells repeated
    ids apart), ``root`` the component's smallest fingerprint.  Null and word-less texts have fingerprint 0 and are linked like any other.  A null id
    takes part but names no component unless no other id is there (then null).  Repeated rows give
    repeated rows; an empty table gives none; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).cast("string").alias("t"))
    local = materialize(rows.mapInArrow(_local_fingerprints(shingle, SEED), "fp bigint, members array<struct<id:bigint,tag:bigint>>"), "fingerprints")
    low = F.array_min(F.transform("members", lambda m: m["id"]))  # array_min skips nulls
    distinct = materialize(local.groupBy("fp").agg(F.min(low).alias("low"), F.count("*").alias("groups")), "distinct_fp")
    roots = connected_components(fingerprint_links(distinct.select("fp"), radius, direct))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(linked.join(names, "root").select("fp", "root", "component_id", "groups"), "named_fp")
    out = _with_names(local, named).select("fp", "root", "component_id", F.explode("members").alias("m"))
    return out.select(F.col("m.id").alias("id"), F.col("m.tag").alias("tag"), "fp", "component_id", "root")


def _with_names(local: DataFrame, named: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """Each slice's group of a fingerprint with its component; groups of hot fingerprints stay where they lie.

    A fingerprint is hot if it has more than ``share`` of all groups, so there are fewer than 1 / share of them: their names are
    broadcast, and the other groups meet their names by a join in which no key is hot.
    """
    total = named.agg(F.sum("groups")).first()[0] or 0
    hot = F.broadcast(named.filter(F.col("groups") > share * total).drop("groups"))
    cold = named.filter(F.col("groups") <= share * total).drop("groups")
    return local.join(hot, "fp").unionByName(local.join(hot.select("fp"), "fp", "left_anti").join(cold, "fp").select("fp", "members", "root", "component_id"))


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits of a signed 64-bit fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The documents with one row per component: its smallest id (any one row where that id repeats)."""
    own = [f"_c{i}" for i in range(len(docs.columns))]
    keyed = docs.toDF(*own)
    i, t = own[docs.columns.index(id_col)], own[docs.columns.index(text_col)]
    found = near_duplicates(keyed, i, t, radius, shingle)
    named = found.filter(F.col("id").eqNullSafe(F.col("component_id")))
    keep = named.groupBy("root").agg(F.min(F.struct("id", "tag")).alias("k")).select(F.col("k.id").alias("_kid"), F.col("k.tag").alias("_ktag"))
    kept = keyed.join(keep, F.col(i).cast("bigint").eqNullSafe(F.col("_kid")) & F.xxhash64(t).eqNullSafe(F.col("_ktag")), "inner")
    order = Window.partitionBy("_kid", "_ktag").orderBy(*orderable(kept, own))
    return kept.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").select(*own).toDF(*docs.columns)
