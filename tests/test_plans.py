"""Plan shape: pushdown through explode, partition pruning, clustering."""

from pyspark.sql import functions as F

from geonest import fixtures as FX
from geonest import schemas as S
from geonest.operators.flatten import flatten_cities
from geonest.plans.explain import plan_text
from geonest.sinks.catalog import write_table
from geonest.sinks.files import cluster_by

SF = "/root/testdata/sf0.001"


def test_parent_filter_reaches_scan(spark):
    docs = FX.location_docs(spark, SF)
    plan = plan_text(flatten_cities(docs, outer=True).filter(F.col("country_code") == "N3"))
    assert "PushedFilters: [IsNotNull(iso3), EqualTo(iso3,N3)]" in plan


def test_partition_filter_prunes(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", "X"), (2, "b", "Y")], "id long, v string, p string")
    write_table(df, "t_prune", "geonest_test", path=f"{tmp_dir}/t", partition_by=["p"])
    plan = plan_text(spark.table("geonest_test.t_prune").filter(F.col("p") == "X"))
    assert "PartitionFilters: [isnotnull(p" in plan and "(p#" in plan


def test_partitioned_write_is_rebalanced(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(cluster_by(df, ["k"]))


def test_replace_partitions_keeps_others(spark, tmp_dir):
    df = spark.createDataFrame([(1, "X"), (2, "Y")], "id long, p string")
    write_table(df, "t_dyn", "geonest_test", path=f"{tmp_dir}/dyn", partition_by=["p"])
    upd = spark.createDataFrame([(3, "X")], "id long, p string")
    write_table(upd, "t_dyn", "geonest_test", path=f"{tmp_dir}/dyn", partition_by=["p"], replace="partitions")
    got = sorted((r.id, r.p) for r in spark.table("geonest_test.t_dyn").collect())
    assert got == [(2, "Y"), (3, "X")]


def test_replicated_docs_scale_linearly(spark):
    docs = FX.location_docs(spark, SF)
    n = flatten_cities(docs, outer=True).count()
    big = FX.replicate_docs(docs, 3)
    assert big.select("id").distinct().count() == 3 * docs.count()
    assert flatten_cities(big, outer=True).count() == 3 * n
    S.assert_contract(flatten_cities(big), "cities")


def test_swap_publishes_view_and_prunes(spark, tmp_dir):
    df = spark.createDataFrame([(1, "X"), (2, "Y")], "id long, p string")
    write_table(df, "t_swap", "geonest_test", path=f"{tmp_dir}/swap", partition_by=["p"], replace="swap", run_id="r1")
    assert spark.table("geonest_test.t_swap").count() == 2
    upd = spark.createDataFrame([(3, "X")], "id long, p string")
    write_table(upd, "t_swap", "geonest_test", path=f"{tmp_dir}/swap", partition_by=["p"], replace="swap", run_id="r2")
    view = spark.table("geonest_test.t_swap")
    assert [(r.id, r.p) for r in view.collect()] == [(3, "X")]
    assert spark.table("geonest_test.t_swap__r1").count() == 2  # earlier run still readable
    assert "PartitionFilters: [isnotnull(p" in plan_text(view.filter(F.col("p") == "X"))


def test_full_replace_registers_only_new_partitions(spark, tmp_dir):
    df = spark.createDataFrame([(1, "X"), (2, "Y")], "id long, p string")
    write_table(df, "t_full", "geonest_test", path=f"{tmp_dir}/full", partition_by=["p"])
    upd = spark.createDataFrame([(3, "Z"), (4, "Z")], "id long, p string")
    write_table(upd, "t_full", "geonest_test", path=f"{tmp_dir}/full", partition_by=["p"])
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS geonest_test.t_full").collect()]
    assert parts == ["p=Z"]
    assert sorted((r.id, r.p) for r in spark.table("geonest_test.t_full").collect()) == [(3, "Z"), (4, "Z")]
    assert spark.table("geonest_test.t_full").columns == ["id", "p"]
