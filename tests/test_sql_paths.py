"""SQL forms of the transforms and spot checks; reference-list and JSON-lines sources."""

from pyspark.sql import functions as F

from geonest import constants as K
from geonest import schemas as S
from geonest.operators.enrich import transform_countries, transform_countries_sql
from geonest.plans.explain import plan_text
from geonest.plans.validate import spot_check_sql
from geonest.sinks.catalog import write_table
from geonest.sources.catalog import read_table, register_view, sql_on
from geonest.sources.json import read_json_lines
from geonest.sources.reference import topics_frame
from tests.test_countries import docs, pop

TS = "2024-01-01 00:00:00"


def test_countries_sql_matches_dataframe_form(spark):
    d = docs(spark, ["AAA", "BBB", None, "CCC"])
    p = pop(spark, [("AA", "AAA", 5), ("BB", "BBB", 7), ("B2", "BBB", 8), ("NN", None, 1)])
    a = transform_countries(d, p, run_ts=TS)
    b = transform_countries_sql(spark, d, p, run_ts=TS)
    assert a.columns == b.columns and a.schema == b.schema
    assert sorted(a.collect()) == sorted(b.collect())
    assert "BroadcastHashJoin" in plan_text(b)


def test_countries_sql_inputs_do_not_leak_as_views(spark):
    d = docs(spark, ["AAA"])
    transform_countries_sql(spark, d, pop(spark, [("AA", "AAA", 5)]), run_ts=TS).collect()
    names = {t.name for t in spark.catalog.listTables()}
    assert "docs" not in names and "pop" not in names


def test_spot_check_sql_binds_values_and_prunes(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1, "Georgia", "GA"), (2, "O'Brien", "OB"), (3, "x", "GA")], "id long, state_name string, state_code string"
    )
    write_table(df, "spot", "geonest_test", path=f"{tmp_dir}/spot", partition_by=["state_code"])
    name = "spark_catalog.geonest_test.spot"
    assert [r.id for r in spot_check_sql(spark, name, "state_name", "O'Brien").collect()] == [2]
    part = spot_check_sql(spark, name, "state_code", "GA")
    assert sorted(r.id for r in part.collect()) == [1, 3]
    assert "PartitionFilters: [isnotnull(state_code" in plan_text(part)
    assert "PushedFilters: [IsNotNull(state_name), EqualTo(state_name,Georgia)]" in plan_text(
        spot_check_sql(spark, name, "state_name", "Georgia")
    )
    top = spot_check_sql(spark, name, n=2, order_by=["id"]).collect()
    assert [r.id for r in top] == [1, 2]
    assert read_table(spark, "spot", "geonest_test", "spark_catalog").count() == 3


def test_register_view_and_sql_on(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    register_view(df, "geonest_view_probe")
    assert spark.sql("SELECT v FROM geonest_view_probe WHERE id = 2").first().v == "b"
    register_view(df.filter("id = 1"), "geonest_view_probe")  # replaces the earlier view
    assert spark.table("geonest_view_probe").count() == 1
    assert sql_on(spark, "SELECT count(*) AS n FROM {t}", t=df).first().n == 2


def test_topics_frame_is_the_fixed_list(spark):
    assert [r.topic for r in topics_frame(spark).collect()] == K.NEWS_TOPICS


def test_json_lines_source(spark, tmp_dir):
    path = f"{tmp_dir}/pop.jsonl"
    with open(path, "w") as f:
        f.write('{"Alpha_2":"AA","Alpha_3":"AAA","Population":5}\n{"Alpha_2":"BB","Alpha_3":"BBB","Population":7}\n')
    got = read_json_lines(spark, path, S.POPULATION)
    assert got.schema == S.POPULATION
    assert sorted((r.Alpha_3, r.Population) for r in got.collect()) == [("AAA", 5), ("BBB", 7)]
    assert got.filter(F.col("Population") > 6).count() == 1
