"""Exact duplicates by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z only.  Three stages, each of which
compares the full normalised text (it is a grouping key beside the digest):

1. *local*: every Arrow batch of a task groups its rows by text, so a hot text leaves a batch as one
   row holding the ids of its copies (at most the batch's rows);
2. *salted*: the local groups are merged by (digest, salt, text), the salt drawn per local group, so
   the copies of a hot text spread over ``salts`` reducers;
3. *global*: the salt winners (at most ``salts`` rows a text) are combined by (digest, text).

The members then look up their winner by (digest, second hash, length): the text is no longer there, so this last
step rests on SHA-256, XXH64 and length together, and texts agreeing in all three would multiply rows.  The winners of hot
texts (more than ``HOT_SHARE`` of all local groups, so at most its inverse of them) are broadcast, and their members
take part in the shuffle for the others under keys of their own: no task gets a hot text's members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.llm.common import forget_kept, text_slices
from barspark.session import materialize

SALTS = 32
#: Texts with more than this share of the local groups are looked up through a broadcast (at most 1 / share of them).
HOT_SHARE = 1e-4
_LOCAL = "digest string, tag bigint, size bigint, ids array<bigint>, top bigint, n bigint"


def _local_groups(with_text: bool, digest_chars: int):
    schema = [("digest", pa.string()), ("tag", pa.int64()), ("size", pa.int64()), ("ids", pa.list_(pa.int64())), ("top", pa.int64()), ("n", pa.int64())]
    schema = pa.schema(schema + ([("norm", pa.string())] if with_text else []))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for part, _ in text_slices(batches, "t"):
            ids = part.column(part.schema.get_field_index("id")).to_pylist()
            norm = pc.fill_null(pc.ascii_lower(part.column(part.schema.get_field_index("t"))), "").to_pylist()
            groups: dict[str, list] = {}
            for i, t in zip(ids, norm):
                groups.setdefault(t, []).append(i)
            raw = [t.encode() for t in groups]
            cols = [
                [hashlib.sha256(b).hexdigest()[:digest_chars] for b in raw],
                [xxhash.xxh64_intdigest(b) - (1 << 63) for b in raw],
                [len(b) for b in raw],
                list(groups.values()),
                [max((i for i in g if i is not None), default=None) for g in groups.values()],
                [len(g) for g in groups.values()],
            ] + ([list(groups)] if with_text else [])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest_chars: int = 64) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the largest id among equal texts, ``group_size`` counts all their rows.  Null text
    counts as empty.  A null id never wins over a non-null one; a group of null ids has a null
    ``keep_id`` and keeps its rows.  Rows repeated with the same id and text are rows of their own and
    all carry ``kept`` (``drop_duplicates`` keeps one).  An empty table gives no rows; other columns
    are ignored.  ``digest_chars`` below 64 truncates the digest (tests force collisions with it);
    results do not change, as full texts are compared and the winner's look-up has XXH64 and length beside it.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("t"))
    full = rows.mapInArrow(_local_groups(True, digest_chars), _LOCAL + ", norm string").drop("ids")
    salted = (
        full.withColumn("salt", F.pmod(F.xxhash64("top", "n"), F.lit(salts)))
        .groupBy("digest", "salt", "norm", "tag", "size")
        .agg(F.max("top").alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"))
    )
    winners = (
        salted.groupBy("digest", "norm", "tag", "size")
        .agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"), F.sum("groups").alias("groups"))
        .drop("norm")
    )
    members = rows.mapInArrow(_local_groups(False, digest_chars), _LOCAL).select("digest", "tag", "size", "ids")
    out = _with_winners(members, materialize(winners, "text-winners")).withColumn("id", F.explode("ids"))
    return out.select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def _with_winners(members: DataFrame, winners: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """Each member row (a local group) with its text's ``keep_id`` and ``group_size``; ``winners`` is a stored table."""
    groups = winners.agg(F.sum("groups")).first()[0] or 0
    hot = winners.where(F.col("groups") > share * groups).select("digest", "tag", "size", F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size"))
    near = members.join(F.broadcast(hot), ["digest", "tag", "size"], "left")
    # a hot text's member has its answer: it goes anywhere, under a key that no winner has
    own = F.when(F.col("hot_size").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("ids").cast("string")))
    cold = winners.where(F.col("groups") <= share * groups).select(F.col("digest").alias("key"), "tag", "size", "keep_id", "group_size")
    found = near.withColumn("key", own).join(cold, ["key", "tag", "size"], "left")
    known = F.col("hot_size").isNotNull()
    return found.select(
        "digest", "ids", F.when(known, F.col("hot_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("hot_size", "group_size").alias("group_size")
    )


def _local_first(id_at: int, text_at: int):
    """Of each slice's equal texts the row with the largest id, with the digest of its normalised text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for part, texts in text_slices(batches, batches_text):
            norm = pc.ascii_lower(pa.array(texts, pa.string())).to_pylist()
            best: dict[str, tuple] = {}
            for k, (i, t) in enumerate(zip(part.column(id_at).to_pylist(), norm)):
                if t not in best or (i is not None and (best[t][0] is None or i > best[t][0])):
                    best[t] = (i, k)
            rows = pa.array([k for _, k in best.values()], pa.int64())
            digests = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in best], pa.string())
            yield pa.RecordBatch.from_arrays([*part.take(rows).columns, digests], names=[*part.schema.names, "digest"])

    batches_text = f"c{text_at}"
    return run


def _first_of_text(text_at: int):
    """The first row of every distinct normalised text; rows come sorted by digest, largest id first.

    Holds the distinct texts of one digest at a time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, set()
        for part, texts in text_slices(batches, f"c{text_at}"):
            norm = pc.ascii_lower(pa.array(texts, pa.string())).to_pylist()
            keep = []
            for digest, t in zip(part.column(part.num_columns - 1).to_pylist(), norm):
                if digest != now:
                    now, seen = digest, set()
                keep.append(t not in seen)
                seen.add(t)
            yield part.filter(pa.array(keep, pa.bool_()))

    return run


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The documents with one row per distinct text (largest id), all columns as they came.

    The same three stages, here carrying whole rows: local (a slice keeps one row a text), salted by
    (digest, salt) and global by digest; the reducers read rows sorted by digest and compare the full
    normalised texts of a digest.  Rows repeated with the same id and text leave one row; null texts
    are one group with ''; an empty table stays empty.
    """
    own = [f"c{i}" for i in range(len(docs.columns))]
    keyed = docs.toDF(*own)
    i, t = docs.columns.index(id_col), docs.columns.index(text_col)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*keyed.schema.fields, T.StructField("digest", T.StringType())])
    order = ["digest", F.desc_nulls_last(own[i])]
    local = keyed.mapInArrow(_local_first(i, t), schema)
    salt = F.pmod(F.xxhash64(own[i]), F.lit(salts))
    salted = local.repartition(parts, "digest", salt).sortWithinPartitions(*order).mapInArrow(_first_of_text(t), schema)
    whole = salted.repartition(parts, "digest").sortWithinPartitions(*order).mapInArrow(_first_of_text(t), schema)
    return whole.select(*own).toDF(*docs.columns)
