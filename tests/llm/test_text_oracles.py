"""The SQL of the text queries, on the given table and on tables with a hot source, rare sources and hot texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barspark.llm import exact_dedup, mixing, queries
from oracle_check import canon, duck

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def skewed(docs):
    """A third of the rows in one source and one source nearly gone."""
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(200))
    return docs.where(~((F.col("source") == "src1") & (pick >= 10))).withColumn("source", F.when((pick < 65) & (F.col("source") != "src1"), "src0").otherwise(F.col("source")))


def beside(docs, name, tmp_path):
    """The table at a place where the query and DuckDB read it."""
    folder = str(tmp_path / name)
    docs.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    con = duck(folder)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return folder, con


@pytest.mark.parametrize("name", ["op8_exact_dedup", "op10_raked_mix"])
@pytest.mark.parametrize("shape", ["given", "skewed", "hot"])
def test_query_equals_its_sql(spark, tmp_path, name, shape):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    if shape == "skewed":
        docs = skewed(docs)
    if shape == "hot":
        docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.lit("The same TEXT, over and over.")).otherwise(F.col("text")))
    folder, con = beside(docs, f"{name}-{shape}", tmp_path)
    got = queries.QUERIES[name](spark, folder).toPandas()
    assert canon(got) == canon(con.execute(queries.ORACLES[name]).df()[got.columns])


def test_the_second_rule_bites_on_the_skewed_table(spark):
    docs = skewed(spark.read.parquet(f"{LARGER}/documents.parquet"))
    rows = mixing.mix(docs, queries.MIX).select("source", "lang", "topic", "probability").distinct().count()
    assert rows > 50
    reached = {r["category"]: r["reached"] / r["target"] for r in mixing.margins(docs, queries.MIX).collect() if r["target"] > 0.02}
    assert min(reached.values()) >= 0.95 - 1e-9


def test_members_of_a_hot_text_spread_over_the_join(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("digest")
        members = spark.range(60_000).select(key, F.lit(1).cast("bigint").alias("tag"), F.lit(1).cast("bigint").alias("size"), F.array("id").alias("ids"))
        winners = members.groupBy("digest", "tag", "size").agg(F.max(F.col("ids")[0]).alias("keep_id"), F.count("*").alias("group_size"), F.count("*").alias("groups"))
        out = exact_dedup._with_winners(members, winners).cache()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 1.3 * min(sizes)
        assert out.where("digest = 'hot' and keep_id = 59997 and group_size = 20000").count() == 20_000
        assert out.where("digest <> 'hot' and keep_id = ids[0] and group_size = 1").count() == 40_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
