"""Population join semantics (JN1, TR1) and its plan."""

from geonest import schemas as S
from geonest.operators.enrich import transform_countries
from geonest.plans.explain import plan_text


def docs(spark, codes):
    rows = []
    for i, code in enumerate(codes):
        d = {n: None for n, _ in S.COUNTRY_SCALARS}
        d.update({"id": i, "name": f"k{i}", "iso3": code, "latitude": "33.93911", "longitude": "x"})
        d["states"] = []
        rows.append(d)
    return spark.createDataFrame(rows, S.COUNTRY)


def pop(spark, rows):
    return spark.createDataFrame(rows, S.POPULATION)


def test_unmatched_duplicate_and_null_keys(spark):
    d = docs(spark, ["AAA", "BBB", None, "DDD"])
    p = pop(spark, [("AA", "AAA", 10), ("BB", "BBB", 20), ("BX", "BBB", 21), (None, None, 99)])
    out = transform_countries(d, p, run_ts="2024-01-01 00:00:00")
    S.assert_contract(out, "countries")
    rows = [(r.country_code, r.population) for r in out.collect()]
    assert ("AAA", 10) in rows
    assert sorted(v for c, v in rows if c == "BBB") == [20, 21]  # fan-out on duplicates
    assert (None, None) in rows  # null key never matches
    assert ("DDD", None) in rows  # unmatched keeps the row
    assert len(rows) == 5


def test_left_join_on_unique_key_keeps_row_count(spark):
    d = docs(spark, ["AAA", "BBB", "CCC"])
    p = pop(spark, [("AA", "AAA", 1), ("BB", "BBB", 2)])
    assert transform_countries(d, p).count() == 3


def test_float_cast_and_constant_timestamp(spark):
    d = docs(spark, ["AAA"])
    r = transform_countries(d, pop(spark, [])).collect()[0]
    assert abs(r.latitude - 33.93911) < 1e-5 and r.longitude is None
    assert str(r.population_source_last_updated_at) == "2020-08-23 16:26:00"


def test_population_is_read_once(spark):
    from geonest import fixtures as FX

    sf = "/root/testdata/sf0.001"
    plan = plan_text(transform_countries(FX.location_docs(spark, sf), FX.population_frame(spark, sf)), "simple")
    assert plan.count("supplier.parquet") == 1 and "Cartesian" not in plan and "NestedLoop" not in plan


def test_unbroadcast_join_splits_a_hot_country(spark):
    from pyspark.sql import functions as F

    # a third of the documents share one code; nothing is broadcast
    docs_df = spark.range(60_000).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("name"),  # incompressible payload
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 500).cast("string"))).alias("iso3"),
        *[F.lit(None).cast("string").alias(c) for c in
          ["capital", "currency", "currency_name", "currency_symbol", "region", "subregion", "phone_code", "emoji"]],
        F.lit("1.5").alias("latitude"), F.lit("2.5").alias("longitude"),
    ).repartition(8)
    pop_df = spark.range(500).select(
        F.lit("x").alias("Alpha_2"), F.concat(F.lit("C"), F.col("id").cast("string")).alias("Alpha_3"),
        F.col("id").alias("Population"),
    ).union(spark.createDataFrame([("h", "HOT", 7)], "Alpha_2 string, Alpha_3 string, Population long"))
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
        out = transform_countries(docs_df, pop_df, run_ts="2024-01-01 00:00:00")
        out = out.select("country_id", "country_name", "country_code", "population")
        rows = out.collect()
        plan = plan_text(out)  # the final adaptive plan of the run above
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 60_000
    assert sum(1 for r in rows if r.country_code == "HOT" and r.population == 7) == 20_000
    # AQE split the hot key's partition of the document side over several tasks
    assert "SortMergeJoin(skew=true)" in plan and "Arguments: skewed" in plan
