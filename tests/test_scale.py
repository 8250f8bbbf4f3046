"""Hot groups, and results that must not depend on how rows are laid out."""

import pytest
from pyspark.sql import functions as F

from kartotek.operators import catalog, kpi, numbering, presence, sinks


def test_hot_table_id_does_not_multiply(spark):
    n = 2000
    flat = spark.range(n).select(
        F.lit("hot").alias("id"), F.concat(F.lit("/p"), F.col("id").cast("string")).alias("path"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("title"),
        F.lit("2024-01-01").alias("published"), F.lit(None).cast("string").alias("updated"), F.lit(1.0).alias("score"), F.lit(1).alias("page_no"),
        F.col("id").cast("int").alias("item_pos"))
    web = spark.range(2 * n).select(
        F.lit("HOT").alias("table_id"), F.array(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("category_ids"), F.array(F.lit("x")).alias("category_names"),
        F.lit("w").alias("title"), F.lit("/h").alias("href"), F.col("id").cast("int").alias("item_pos"))
    nav = spark.createDataFrame([], "path_key string, id_key string, title string, published string, updated string, score double")
    got = catalog.match_metadata(web, flat, nav).groupBy("tier").agg(F.count("*").alias("n"), F.countDistinct("title").alias("t")).collect()
    assert {r.tier: (r.n, r.t) for r in got} == {"exact": (n, n), "same_id": (n, 1)}


def test_a_hot_group_spreads_over_tasks(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("hot").alias("g"), F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        placed = numbering.ordinals(rows, ["g"], ["k"], bounds=numbering.range_bounds(rows, "k", 64))
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 9000 and max(sizes) < 2000
    ends = placed.groupBy("g").agg(F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi"), F.countDistinct("ordinal").alias("n"))
    assert {r.g: (r.lo, r.hi, r.n) for r in ends.collect()} == {"a": (0, 2999, 3000), "hot": (0, 5999, 6000)}


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_layout_does_not_matter(spark, data_dir, parts):
    from kartotek.plans.bindings import Tables

    t = Tables(spark, data_dir)

    def digest(df):
        cols = [F.to_json(F.struct("*"))]
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first())

    def shuffled(df):
        return df.repartition(parts, F.rand(parts))

    obs = t.observations
    assert digest(presence.presence(shuffled(obs))) == digest(presence.presence(obs))
    assert digest(catalog.walk(shuffled(t.nav))) == digest(catalog.walk(t.nav))
    filled = catalog.web_only_metadata(t.web, t.flat, t.folder_entries)
    assert digest(catalog.match_metadata(shuffled(t.web), shuffled(t.flat), filled)) == digest(catalog.match_metadata(t.web, t.flat, filled))
    docs = t.events.select(F.col("user_id").alias("u"), F.col("event_id").alias("run_no"), "event_type")
    assert digest(sinks.upsert_documents(docs.limit(0), shuffled(docs), ["u"])) == digest(sinks.upsert_documents(docs.limit(0), docs, ["u"]))
    ids = t.customer.select(F.col("c_custkey").cast("string").alias("area_id"))
    plans = [kpi.probe_batches(d, 2010, 2029, bounds=b).select("batch_id", "area_ids") for d, b in ((ids, None), (shuffled(ids), ["1", "25", "7"]))]
    assert digest(plans[0]) == digest(plans[1])


def test_kpi_feeds_of_one_small_file_are_parsed_in_many_tasks(spark, data_dir):
    from kartotek.plans.bindings import Tables

    t = Tables(spark, data_dir)
    for bodies, n in ((t.kpi_bodies, t.part.count()), (t.group_bodies, None)):
        sizes = [r["count"] for r in bodies.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and n in (None, sum(sizes))


def test_a_large_partition_is_written_in_pieces(spark, tmp_path):
    rows = spark.range(6_000_000).select(F.xxhash64("id").alias("v"), F.lit("one").alias("g"))
    names = ("advisoryPartitionSizeInBytes", "coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(f"spark.sql.adaptive.{n}", None) for n in names]
    sinks.write_partitioned(rows, str(tmp_path / "out"), "g")
    assert len(list((tmp_path / "out" / "g=one").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6_000_000
    assert [spark.conf.get(f"spark.sql.adaptive.{n}", None) for n in names] == before


def test_no_table_of_datasets_is_broadcast(spark, data_dir):
    """Estimates come from the bytes of the files, so a broadcast of datasets would grow with them on the driver."""
    from kartotek.plans import harvest, q_runs
    from kartotek.plans.bindings import Tables

    t, run, api = Tables(spark, data_dir), harvest.Run("r", "demo", "sv", q_runs.START), "https://h.org/api/v1/sv/Db"
    raw, known = q_runs.v2_landed(t)
    none = spark.createDataFrame([], harvest.schemas.STATE)
    for result in (harvest.run_tables_v2(raw, known, run, "https://a.org"), harvest.run_tables_v1(q_runs.v1_landed(t, api), none, run, api)):
        assert result.outcomes.count() > 0
        plan = result.outcomes._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
