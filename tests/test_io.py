"""Sources and sinks: JSON conversion, table replacement, news layouts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from geonest import schemas as S
from geonest.plans.location import convert_json_to_parquet, dataset_frames, run_elt
from geonest.plans.news import load_news
from geonest.sinks.catalog import read_contract, write_table
from geonest.sinks.files import append_partitioned, write_parquet_overwrite
from geonest.sources.news import read_news_layout, read_response_files, read_response_log


def _local(p):
    return p.replace("file:", "")


def write_doc_file(path, docs):
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), "part.json"), "w") as f:
        json.dump(docs, f, indent=2)


DOC = {
    "id": 1, "name": "Nigeria", "iso3": "NGA", "capital": "Abuja", "latitude": "10", "longitude": "8",
    "states": [{"id": 5, "name": "Lagos", "state_code": "LA", "latitude": "6.5", "longitude": "3.4",
                "cities": [{"id": 9, "name": "Ikeja", "latitude": "6.6", "longitude": "3.3"}]}],
}


def test_convert_multiline_json(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    write_doc_file(raw, [DOC, {**DOC, "id": 2, "states": []}])
    convert_json_to_parquet(spark, raw, out, S.COUNTRY)
    df = spark.read.parquet(out)
    assert df.count() == 2
    assert df.schema["states"].dataType == S.COUNTRY["states"].dataType


def test_convert_corrupt_json_fails_fast(spark, tmp_dir):
    raw = f"{tmp_dir}/bad"
    os.makedirs(_local(raw), exist_ok=True)
    with open(os.path.join(_local(raw), "x.json"), "w") as f:
        f.write('[{"id": 1, "name": ')
    with pytest.raises(Exception):
        convert_json_to_parquet(spark, raw, f"{tmp_dir}/o2", S.COUNTRY)


def test_refuses_overwriting_input(spark, tmp_dir):
    with pytest.raises(ValueError):
        write_parquet_overwrite(spark.range(1), f"{tmp_dir}/x", input_paths=[f"{tmp_dir}/x/"])


def test_replace_table_twice(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", "X"), (2, "b", "Y")], "id long, v string, p string")
    write_table(df, "t_replace", "geonest_test", path=f"{tmp_dir}/t", partition_by=["p"])
    write_table(df.limit(1), "t_replace", "geonest_test", path=f"{tmp_dir}/t", partition_by=["p"])
    back = spark.table("geonest_test.t_replace")
    assert back.count() == 1
    assert read_contract(back, ["id", "v", "p"]).columns == ["id", "v", "p"]


def test_unknown_dataset_raises(spark):
    with pytest.raises(ValueError):
        dataset_frames("planets", spark.range(1), None, None)


def test_run_elt_states_cities(spark, tmp_dir):
    raw, pre = f"{tmp_dir}/raw", f"{tmp_dir}/pre"
    write_doc_file(raw, [DOC, {**DOC, "id": 2, "iso3": "GHA", "states": []}])
    convert_json_to_parquet(spark, raw, pre, S.COUNTRY)
    checks = run_elt(spark, "states_cities", pre, location=f"{tmp_dir}/tables", database="geonest_elt")
    got = {(r.table_name, r.check_name): r.value for r in checks.collect()}
    assert got[("states", "row_count")] == 2 and got[("states", "null_state_id")] == 1
    assert got[("cities", "row_count")] == 2 and got[("cities", "duplicate_keys")] == 0
    cities = spark.table("geonest_elt.cities")
    assert cities.filter(F.col("country_code") == "NGA").count() == 1


def test_news_append_and_layouts(spark, tmp_dir):
    body = json.dumps({"status": "ok", "articles": [{"id": 1, "text": "t", "n_chars": 1}]})
    land = f"{tmp_dir}/landing"
    env = spark.createDataFrame(
        [("NG", "tech", 0, "2024-03-04 00:00:00", body)], "country string, topic string, page long, requested_at string, body string"
    ).withColumn("requested_at", F.col("requested_at").cast("timestamp"))
    env.write.json(land)
    table = f"{tmp_dir}/news"
    load_news(spark, land, table)
    load_news(spark, land, table)
    back = spark.read.parquet(table)
    assert back.count() == 2
    loads = [x for x in os.listdir(_local(table)) if x.startswith("load=")]  # beside the log
    assert len(loads) == 2 and all(os.path.isdir(os.path.join(_local(table), x, "date=2024-03-04", "country=NG", "topic=tech")) for x in loads)
    assert read_response_log(spark, land).count() == 1

    # one-body-per-file landing and the plain yyyy/MM/dd layout
    files = f"{tmp_dir}/files/NG/tech"
    os.makedirs(_local(files), exist_ok=True)
    with open(os.path.join(_local(files), "r1.json"), "w") as f:
        f.write(body)
    r = read_response_files(spark, f"{tmp_dir}/files").collect()[0]
    assert (r.country, r.topic, r.body) == ("NG", "tech", body)
    plain = f"{tmp_dir}/plain/newscatcher/2024/03/04/NG/tech"
    spark.range(3).write.parquet(plain)
    row = read_news_layout(spark, f"{tmp_dir}/plain").select("date", "country", "topic").distinct().collect()
    assert [tuple(x) for x in row] == [("2024-03-04", "NG", "tech")]


def test_partitioned_append_clusters(spark, tmp_dir):
    df = spark.range(1000).withColumn("k", (F.col("id") % 3).cast("string")).repartition(8)
    append_partitioned(df, f"{tmp_dir}/p", ["k"])
    n_files = sum(
        len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(_local(f"{tmp_dir}/p"))
    )
    assert n_files <= 6  # not 8 tasks x 3 folders


def test_empty_partition_value_is_rejected(spark, tmp_dir):
    df = spark.createDataFrame([(1, ""), (2, None)], "id long, p string")
    with pytest.raises(Exception, match="empty string in partition column p"):
        append_partitioned(df, f"{tmp_dir}/e", ["p"])
    ok = spark.createDataFrame([(2, None)], "id long, p string")
    append_partitioned(ok, f"{tmp_dir}/n", ["p"])
    assert spark.read.parquet(f"{tmp_dir}/n").count() == 1


def test_load_news_from_files(spark, tmp_dir):
    body = json.dumps({"status": "ok", "articles": [{"id": 7, "text": "t", "n_chars": 1}]})
    d = f"{tmp_dir}/bodies/NG/tech"
    os.makedirs(_local(d), exist_ok=True)
    with open(os.path.join(_local(d), "r.json"), "w") as f:
        f.write(body)
    with open(os.path.join(_local(d), "bad.json"), "w") as f:
        f.write("{bad")
    rejects = load_news(spark, f"{tmp_dir}/bodies", f"{tmp_dir}/news2", landing="files", run_ts="2024-02-03 04:05:06")
    back = spark.read.parquet(f"{tmp_dir}/news2").collect()
    assert [(r.id, r.call_timestamp, str(r.date)) for r in back] == [(7, "2024-02-03T04:05:06.000000Z", "2024-02-03")]
    assert [r.response_class for r in rejects.collect()] == ["malformed"]


def test_hot_partition_value_is_split_over_tasks(spark, tmp_dir):
    # 90% of the rows share one folder key; AQE splits that rebalance
    # partition into several tasks (several files), cold keys stay one file.
    df = spark.range(200_000).select(
        "id", F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(F.lit(99)).cast("string").alias("k"),
        F.repeat(F.lit("x"), 20).alias("pad"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        append_partitioned(df, f"{tmp_dir}/skew", ["k"])
    finally:
        spark.conf.set(key, before)
    base = _local(f"{tmp_dir}/skew")
    files = {d: len([f for f in os.listdir(os.path.join(base, d)) if f.endswith(".parquet")])
             for d in os.listdir(base) if d.startswith("k=")}
    assert files["k=99"] > 1
    assert all(n == 1 for d, n in files.items() if d != "k=99")
    assert spark.read.parquet(base).count() == 200_000
