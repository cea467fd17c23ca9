"""Table sink: a failed replace keeps the old rows; SK2-SK5."""

import pytest
from pyspark.sql import functions as F

from geonest.plans.location import run_elt
from geonest.sinks.catalog import write_table
from geonest.sinks.files import overlap, write_parquet_overwrite

DB = "geonest_sinks"
ROWS = [(1, "a", "X"), (2, "b", "Y")]
SCHEMA = "id long, v string, p string"


def rows(spark, name):
    return sorted((r.id, r.v, r.p) for r in spark.table(f"{DB}.{name}").select("id", "v", "p").collect())


@pytest.mark.parametrize("parts", [None, ["p"]])
def test_a_failed_task_keeps_the_old_rows(spark, tmp_dir, parts):
    name = f"t_fail_{len(parts or [])}"
    df = spark.createDataFrame(ROWS, SCHEMA)
    write_table(df, name, DB, path=f"{tmp_dir}/t", partition_by=parts)
    bad = df.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("broken row"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken row"):
        write_table(bad, name, DB, path=f"{tmp_dir}/t", partition_by=parts)
    assert rows(spark, name) == ROWS
    assert not [t.name for t in spark.catalog.listTables(DB) if "staged" in t.name or "before" in t.name]


def test_an_empty_partition_value_keeps_the_old_rows(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, SCHEMA)
    write_table(df, "t_empty", DB, path=f"{tmp_dir}/t", partition_by=["p"])
    with pytest.raises(Exception, match="empty string in partition column p"):
        write_table(df.union(spark.createDataFrame([(3, "c", "")], SCHEMA)), "t_empty", DB, path=f"{tmp_dir}/t", partition_by=["p"])
    assert rows(spark, "t_empty") == ROWS


def test_a_location_that_is_an_input_is_refused(spark, tmp_dir):
    src = f"{tmp_dir}/in/states"
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(src)
    for location in (src, f"{tmp_dir}/in", f"{src}/deeper"):
        with pytest.raises(ValueError, match="overlaps an input"):
            write_table(spark.read.parquet(src), "t_in", DB, path=location, input_paths=[src])
        with pytest.raises(ValueError, match="overlaps an input"):
            write_parquet_overwrite(spark.read.parquet(src), location, input_paths=[src])
    assert spark.read.parquet(src).count() == 2
    with pytest.raises(ValueError, match="overlaps an input"):
        run_elt(spark, "states", src, location=f"{tmp_dir}/in", database=DB)
    assert not overlap("/a/b", "/a/bc") and overlap("file:///a/b/", "/a/b")


def test_a_table_reads_its_own_rows_into_the_replacement(spark, tmp_dir):
    write_table(spark.createDataFrame(ROWS, SCHEMA), "t_self", DB, path=f"{tmp_dir}/t", partition_by=["p"])
    write_table(spark.table(f"{DB}.t_self").where("id = 2"), "t_self", DB, path=f"{tmp_dir}/t", partition_by=["p"])
    assert rows(spark, "t_self") == ROWS[1:]


def test_swap_after_full_and_full_after_swap(spark, tmp_dir):
    one, two, three = (spark.createDataFrame([(i, "v", "X")], SCHEMA) for i in (1, 2, 3))
    write_table(one, "t_mixed", DB, path=f"{tmp_dir}/t", partition_by=["p"])
    write_table(two, "t_mixed", DB, path=f"{tmp_dir}/t", partition_by=["p"], replace="swap", run_id="r2")
    assert rows(spark, "t_mixed") == [(2, "v", "X")] and rows(spark, "t_mixed__before_r2") == [(1, "v", "X")]
    write_table(three, "t_mixed", DB, path=f"{tmp_dir}/t", partition_by=["p"])
    assert rows(spark, "t_mixed") == [(3, "v", "X")]


def test_without_a_path_the_table_lies_in_its_database(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for _ in range(2):
        write_table(df, "t_default", DB, partition_by=["p"], catalog="spark_catalog")
    assert rows(spark, "t_default") == ROWS


def test_table_format_and_properties(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, SCHEMA)
    write_table(df, "t_props", DB, path=f"{tmp_dir}/t", fmt="orc", table_properties={"orc.compress": "ZLIB", "owner_team": "places"})
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {DB}.t_props").collect()}
    assert found["Provider"].lower() == "orc" and "owner_team=places" in (found.get("Storage Properties", "") + found.get("Table Properties", ""))
    assert f"{tmp_dir}/t".replace("file:", "") in found["Location"] and rows(spark, "t_props") == ROWS


def test_partition_replace_leaves_the_session_setting_alone(spark, tmp_dir):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    write_table(spark.createDataFrame(ROWS, SCHEMA), "t_part", DB, path=f"{tmp_dir}/t", partition_by=["p"])
    write_table(spark.createDataFrame([(9, "z", "X")], SCHEMA), "t_part", DB, path=f"{tmp_dir}/t", partition_by=["p"], replace="partitions")
    assert rows(spark, "t_part") == [(2, "b", "Y"), (9, "z", "X")] and spark.conf.get(key) == before
