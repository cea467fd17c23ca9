"""Flatten semantics on literal nested documents (GE1-GE4, TR2-TR4)."""

import pytest
from pyspark.sql import Row

from geonest import schemas as S
from geonest.plans.explain import plan_text
from geonest.operators.flatten import flatten_cities, flatten_states, flatten_states_and_cities

RUN = "2024-05-01 12:00:00"


def city(i, lat="1.5", lon="-2.5"):
    return {"id": i, "name": f"c{i}", "latitude": lat, "longitude": lon}


def state(i, cities, code=None):
    return {"id": i, "name": f"s{i}", "state_code": code or f"S{i}", "latitude": "10", "longitude": "20", "cities": cities}


def country(i, states):
    base = {n: None for n, _ in S.COUNTRY_SCALARS}
    base.update({"id": i, "name": f"k{i}", "iso3": f"K{i}"})
    base["states"] = states
    return base


@pytest.fixture()
def docs(spark):
    data = [
        country(1, [state(10, [city(100), city(101)]), state(11, [])]),  # one empty city list
        country(2, None),  # null states
        country(3, []),  # empty states
        country(4, [state(40, None)]),  # null cities
        country(5, [None, state(50, [None, city(500, "", "abc")])]),  # null elements
    ]
    return spark.createDataFrame(data, S.COUNTRY)


def test_states_inner_drops_childless_countries(docs):
    rows = flatten_states(docs, outer=False, run_ts=RUN).collect()
    assert sorted((r.country_id, r.state_id) for r in rows if r.state_id is not None) == [
        (1, 10), (1, 11), (4, 40), (5, 50)
    ]
    # a null element of the array still yields a row (all state fields null)
    assert len(rows) == 5
    assert {r.country_id for r in rows} == {1, 4, 5}


def test_states_outer_keeps_childless_countries(docs):
    rows = flatten_states(docs, outer=True, run_ts=RUN).collect()
    by_country = {}
    for r in rows:
        by_country.setdefault(r.country_id, []).append(r.state_id)
    assert by_country[2] == [None] and by_country[3] == [None]
    assert len(rows) == 7


def test_cities_inner(docs):
    rows = flatten_cities(docs, outer=False, run_ts=RUN).collect()
    assert sorted(r.city_id for r in rows if r.city_id is not None) == [100, 101, 500]
    assert len(rows) == 4  # plus the null city element of state 50


def test_cities_outer(docs):
    rows = flatten_cities(docs, outer=True, run_ts=RUN).collect()
    keys = [(r.country_id, r.state_id, r.city_id) for r in rows]
    assert (1, 11, None) in keys  # state with empty cities
    assert (2, None, None) in keys and (3, None, None) in keys
    assert (4, 40, None) in keys  # state with null cities
    assert (5, None, None) in keys  # null state element
    assert len(rows) == 9


def test_outer_minus_null_children_is_inner(docs):
    outer = flatten_cities(docs, outer=True, run_ts=RUN)
    inner = flatten_cities(docs, outer=False, run_ts=RUN)
    assert set(inner.collect()) <= set(outer.collect())
    from pyspark.sql import functions as F

    null_child = outer.filter(F.col("city_id").isNull()).count()
    inner_null_child = inner.filter(F.col("city_id").isNull()).count()
    assert outer.count() - null_child == inner.count() - inner_null_child


def test_float_parsing_and_stamps(docs):
    rows = {r.city_id: r for r in flatten_cities(docs, outer=False, run_ts=RUN).collect()}
    assert rows[100].latitude == pytest.approx(1.5) and rows[100].longitude == pytest.approx(-2.5)
    assert rows[500].latitude is None and rows[500].longitude is None  # '' and 'abc'
    r = rows[100]
    assert r.created_at == r.last_updated_at
    assert str(r.created_at) == RUN


def test_contract_order(docs):
    s, c = flatten_states_and_cities(docs, run_ts=RUN)
    S.assert_contract(s, "states")
    S.assert_contract(c, "cities")
    assert dict(s.dtypes)["latitude"] == "float"


def test_row_count_properties(spark, docs):
    from pyspark.sql import functions as F

    sizes = docs.select(F.coalesce(F.size("states"), F.lit(-1)).alias("n")).collect()
    inner = sum(max(0, r.n) for r in sizes)
    outer = sum(max(1, r.n) for r in sizes)
    assert flatten_states(docs, outer=False).count() == inner
    assert flatten_states(docs, outer=True).count() == outer


def test_state_scan_prunes_cities(spark, tmp_dir, docs):
    docs.write.mode("overwrite").parquet(tmp_dir)
    read = spark.read.schema(S.COUNTRY).parquet(tmp_dir)
    plan = plan_text(flatten_states(read, outer=True))
    read_schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "cities" not in read_schema
    assert "state_code" in read_schema


def test_flatten_is_narrow(spark, docs):
    plan = plan_text(flatten_cities(docs, outer=True))
    assert "Exchange" not in plan
