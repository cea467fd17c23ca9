"""Fixture builder: nesting in parts by key ranges, and multi-line JSON files."""

import glob
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from geonest import fixtures as FX
from geonest.operators.enrich import transform_countries
from geonest.operators.flatten import flatten_cities, flatten_states
from geonest.oracle import COUNTRIES, cities_sql, states_sql
from geonest.registry import comparable

SF = "/root/testdata/sf0.001"
TS = FX.FIXED_RUN_TS


@pytest.fixture(scope="module")
def hot(spark):
    """One customer with most orders, one order with most lines, and the
    rare cases: no orders, no lines, HOUSEHOLD, null segment and keys."""
    t = {}
    t["region"] = spark.createDataFrame([(0, "R0")], "r_regionkey int, r_name string")
    t["nation"] = spark.createDataFrame([(0, "N0", 0), (1, "N1", None)], "n_nationkey int, n_name string, n_regionkey int")
    t["supplier"] = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "s_suppkey long, s_nationkey int")
    cust = [(1, "hot", 0, "BUILDING", 1.5), (2, "none", 1, "AUTOMOBILE", -2.25), (3, "home", 0, "HOUSEHOLD", 0.0), (4, "few", 1, None, 9.0)]
    t["customer"] = spark.createDataFrame(cust, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double")
    order = "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string, o_totalprice double"
    t["orders"] = (
        spark.range(30_000).selectExpr("id as o_orderkey", "1L as o_custkey", "'1-URGENT' as o_orderpriority", "if(id % 3 = 0, 'P', 'O') as o_orderstatus", "cast(id as double) as o_totalprice")
        .union(spark.createDataFrame([(40_000, 4, "5-LOW", "F", 7.5), (40_001, 3, "5-LOW", "F", 1.0), (40_002, None, "5-LOW", "F", 1.0)], order))
    )
    line = "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_extendedprice double"
    t["lineitem"] = (
        spark.range(20_000).selectExpr("7L as l_orderkey", "cast(id as int) as l_linenumber", "if(id % 5 = 0, 'R', 'N') as l_returnflag", "if(id % 2 = 0, 'O', 'F') as l_linestatus", "id / 4 as l_extendedprice")
        .union(spark.createDataFrame([(40_000, 1, "A", "F", 3.0), (40_000, 2, "N", "F", 3.0), (40_001, 1, "N", "F", 1.0), (None, 1, "N", "F", 1.0), (8, 3, "N", "F", 2.0)], line))
    )
    con = duckdb.connect()
    for name, df in t.items():
        con.register(name, df.toArrow())
    docs = FX.location_docs_of(t["customer"], t["orders"], t["lineitem"], t["nation"], t["region"])
    return t, docs.cache(), con


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_as(df, con, sql):
    want = con.sql(sql)
    cols = want.columns
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(comparable(df).select(*cols)) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize("outer", [True, False])
def test_a_hot_customer_and_order_equal_the_oracle_row_for_row(hot, outer):
    _, docs, con = hot
    same_as(flatten_cities(docs, outer=outer, run_ts=TS), con, cities_sql(outer))
    same_as(flatten_states(docs, outer=outer, run_ts=TS), con, states_sql(outer))


def test_countries_of_a_hot_customer_equal_the_oracle(hot):
    t, docs, con = hot
    population = t["supplier"].groupBy("s_nationkey").count().selectExpr("concat('A', s_nationkey) as Alpha_2", "concat('N', s_nationkey) as Alpha_3", "`count` as Population")
    same_as(transform_countries(docs, population, run_ts=TS), con, COUNTRIES)


def test_parts_bound_every_array(hot):
    _, docs, _ = hot
    size = docs.select(F.max(F.size("states")), F.max(F.expr("aggregate(states, 0, (m, s) -> greatest(m, size(s.cities)))"))).first()
    # the hot order's entries all lie in one range of order keys: its entries, not its cities, add up
    assert size[1] <= FX.CITIES_PER_PART
    assert docs.where("id = 1").count() == -(-30_000 // FX.STATES_PER_PART)


def test_with_children_pairs_and_childless(spark):
    parents = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    children = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "ck long, v string")
    matched, childless = FX.with_children(parents, children, "k", "ck")
    assert sorted(r.v for r in matched.collect()) == ["a", "b"]
    assert sorted((r.k for r in childless.collect()), key=repr) == [2, None]


def test_a_hot_parents_children_are_split_over_tasks(spark):
    from geonest.plans.explain import plan_text

    parents = spark.range(1000).select(F.col("id").alias("k"), F.lit("p").alias("pv"))
    children = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("ck"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),  # incompressible
    ).repartition(8)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = FX.with_children(parents, children, "k", "ck")[0].select("k", "payload")
        assert out.count() == len(out.collect()) == 60_000
        plan = plan_text(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan


def test_multiline_json_files_are_arrays(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "id long, v string")
    path = FX.write_multiline_json(df, f"{tmp_dir}/ml", n_files=2)
    rows = []
    for f in glob.glob(f"{path}/_file=*/part-*"):
        rows += json.load(open(f))  # each file is one JSON array
    assert sorted((r["id"], r.get("v")) for r in rows) == [(1, "a"), (1, "a"), (2, "b"), (3, None)]


def test_raw_files_are_sized_by_bytes_and_spread_a_hot_id(spark, tmp_dir):
    df = spark.range(400).selectExpr("1L as id", "concat(id, repeat('x', 100)) as v")
    path = FX.write_multiline_json(df, f"{tmp_dir}/ml", file_bytes=5_000)
    sizes = [len(json.load(open(f))) for f in glob.glob(f"{path}/_file=*/part-*")]
    assert sum(sizes) == 400 and len(sizes) >= 8 and max(sizes) < 100


def test_customers_meet_their_parts_by_null_and_repeated_keys(spark):
    cust = "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"
    customers = spark.createDataFrame([(1, "twice", 0, "BUILDING", 1.5)] * 2 + [(2, "none", 0, "BUILDING", 1.5), (None, "null", 0, "BUILDING", 1.5)], cust)
    order = "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string, o_totalprice double"
    orders = spark.createDataFrame(
        [(None, 1, "a", "F", 1.0), (None, 1, "b", "F", 1.0), (5, 1, "c", "F", 1.0), (-5, 1, "d", "F", 1.0), (-9_000, 1, "e", "F", 1.0), (9_000, 1, "f", "F", 1.0), (7, None, "g", "F", 1.0)], order
    )
    lines = spark.createDataFrame([(5, 1, "N", "F", 3.0)], "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_extendedprice double")
    nations = spark.createDataFrame([(0, "N0", 0)], "n_nationkey int, n_name string, n_regionkey int")
    regions = spark.createDataFrame([(0, "R0")], "r_regionkey int, r_name string")
    docs = FX.location_docs_of(customers, orders, lines, nations, regions)
    got = sorted((d.name, sorted(s.name for s in d.states) if d.states is not None else None) for d in docs.collect())
    parts = [["a", "b"], ["c", "d"], ["e"], ["f"]]  # by range of the order key, a null key apart
    assert got == [("none", None), ("null", None)] + sorted(("twice", p) for p in parts for _ in range(2))


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def test_built_input_leaves_no_shuffle_files(spark, hot, tmp_dir, monkeypatch):
    import time

    t, _, _ = hot
    for name in ("customer", "orders", "lineitem", "nation", "region"):
        t[name].write.parquet(f"{tmp_dir}/in/{name}.parquet")
    monkeypatch.setattr(FX, "_materialised", {})
    before = _shuffle_files(spark)
    docs = FX.location_docs(spark, f"{tmp_dir}/in")
    FX.write_multiline_json(docs, f"{tmp_dir}/raw", n_files=3)
    for _ in range(50):  # files go in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and docs.count() > 4


def test_compressed_raw_files_convert_to_the_same_documents(spark, hot, tmp_dir):
    from geonest import schemas as S
    from geonest.plans.location import convert_json_to_parquet
    from geonest.registry import RAW_CODEC

    _, docs, _ = hot
    FX.write_multiline_json(docs, f"{tmp_dir}/plain", n_files=2)
    FX.write_multiline_json(docs, f"{tmp_dir}/small", n_files=2, compression=RAW_CODEC)
    size = {k: sum(len(open(f, "rb").read()) for f in glob.glob(f"{tmp_dir}/{k}/_file=*/part-*")) for k in ("plain", "small")}
    assert 0 < 3 * size["small"] < size["plain"]
    for k in ("plain", "small"):
        convert_json_to_parquet(spark, f"{tmp_dir}/{k}", f"{tmp_dir}/out-{k}", S.COUNTRY)
    got = [rows_of(spark.read.schema(S.COUNTRY).parquet(f"{tmp_dir}/out-{k}")) for k in ("plain", "small")]
    assert got[0] == got[1] == rows_of(docs)
