"""Multi-line JSON by byte ranges: the same rows as the whole-file reader, whatever the splits cut."""

import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geonest import schemas as S
from geonest.operators.enrich import transform_countries
from geonest.operators.flatten import flatten_cities, flatten_states
from geonest.sources import json_ranges as R
from geonest.sources.json import read_multiline_json
from geonest.sources.json_ranges import read_json_ranges, read_json_units, read_location_pieces

TRICKY = ["}", "{", "]", "[", '"', "\\", '\\"', "}{][", 'a"}', "\\\\", "é}", "{\"states\":[", "\n\t", "", "}\\", ",", ":"]


@pytest.fixture()
def tiny_splits(spark):
    """Splits of a few bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "7", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def _country(rng, i):
    word = lambda: "".join(rng.choice(TRICKY) for _ in range(rng.randrange(3)))
    cities = lambda: [{"id": rng.randrange(99), "name": word(), "latitude": "1.5"} for _ in range(rng.randrange(4))]
    states = [{"name": word(), "id": 10 * i + k, "cities": cities(), "state_code": word()} for k in range(rng.randrange(4))]
    for s in states:
        if rng.random() < 0.3:
            s["cities"] = rng.choice([None, []])
    doc = {"id": i, "name": word(), "timezones": [{"states": [{"id": 1}], "x": word()}], "states": states, "iso3": word(), "translations": {"}": word(), "cities": [1, {"a": []}]}}
    if rng.random() < 0.2:
        doc["states"] = rng.choice([None, []])
    if rng.random() < 0.1:
        del doc["states"]
    return doc


def _land(path, docs, indent):
    with open(path, "w", encoding="utf-8") as f:
        json.dump(docs, f, indent=indent, ensure_ascii=False)
        if indent:
            f.write("\n")


def _rows(df):
    return sorted(map(repr, df.collect()))


def _cut(data, size, levels=()):
    """Units of a file whose splits are ``size`` bytes, by the functions that the tasks run."""
    records = data.split(b"}")
    if records[-1] == b"":
        records.pop()
    at, rows = 0, []
    for r in records:
        rows.append((at // size * size, r))
        at += len(r) + 1
    parts = []
    for split in sorted({k for k, _ in rows}):
        mine = [r for k, r in rows if k == split]
        n = len(mine)
        parts.append(pa.RecordBatch.from_arrays(
            [pa.array(["f"] * n), pa.array([len(data)] * n), pa.array([split] * n), pa.array(mine, pa.binary())], ["file", "size", "split", "value"]
        ))

    class Held:
        value = None

    sums = [r for b in parts for out in R._count([b]) for r in out.to_pylist()]
    Held.value = R._begin(sums)
    limit = 2 + 2 * len(levels)
    R._with_stacks(Held.value, [r for b in parts for out in R._open_brackets(Held, limit)([b]) for r in out.to_pylist()], limit)
    units = {}
    for b in parts:
        for out in R._cut_units(Held, tuple(levels))([b]):
            for u in out.to_pylist():
                units.setdefault((u["level"], u["id"], u["parent"]), []).append((u["fragment"], u["text"]))
    assert all(len(f) == 1 or None not in [x for x, _ in f] for f in units.values())
    return {k: "".join(t for _, t in sorted(f, key=lambda x: (x[0] is not None, x[0]))) for k, f in units.items()}


def _nested(units):
    """The documents again from their units."""
    found = {k: json.loads(t) for k, t in sorted(units.items())}
    names = {1: "states", 2: "cities"}
    for (level, _, parent), value in found.items():
        if level:
            next(v for k, v in found.items() if k[0] == level - 1 and k[1] == parent)[names[level]].append(value)
    return [v for k, v in found.items() if k[0] == 0]


@pytest.mark.parametrize("indent", [None, 2])
def test_every_cut_gives_the_same_documents(indent):
    rng = random.Random(8)
    docs = [_country(rng, i) for i in range(12)]
    data = (json.dumps(docs, indent=indent, ensure_ascii=False) + ("\n" if indent else "")).encode()
    for size in [*range(1, 40, 3), 64, 100, 1 << 10, 1 << 20]:
        assert _nested(_cut(data, size)) == docs
        assert _nested(_cut(data, size, ("states", "cities"))) == docs
    one = json.dumps(docs[0], indent=indent).encode()
    for size in range(1, 60, 7):
        assert _nested(_cut(one, size, ("states", "cities"))) == docs[:1]


def test_same_rows_as_the_whole_file_reader(spark, tmp_dir, tiny_splits):
    rng = random.Random(8)
    path = f"{tmp_dir}/c"
    os.makedirs(path)
    _land(f"{path}/many.json", [_country(rng, i) for i in range(9)], 1)
    _land(f"{path}/one.json", _country(rng, 50), None)
    _land(f"{path}/none.json", [], 1)
    whole = read_multiline_json(spark, path, S.COUNTRY)
    tiny_splits(900)
    got = read_json_ranges(spark, path, S.COUNTRY)
    pieces = read_location_pieces(spark, path)
    tiny_splits(1 << 20)
    assert _rows(got) == _rows(whole)
    for outer in (True, False):
        assert _rows(flatten_states(pieces["states"], outer=outer, run_ts="2024-01-01")) == _rows(flatten_states(whole, outer=outer, run_ts="2024-01-01"))
        assert _rows(flatten_cities(pieces["cities"], outer=outer, run_ts="2024-01-01")) == _rows(flatten_cities(whole, outer=outer, run_ts="2024-01-01"))
    population = spark.createDataFrame([("XX", "YYY", 5)], S.POPULATION)
    assert _rows(transform_countries(pieces["countries"], population, "2024-01-01")) == _rows(transform_countries(whole, population, "2024-01-01"))


def test_a_single_array_is_read_by_a_task_per_split(spark, tmp_dir, tiny_splits):
    path = f"{tmp_dir}/big.json"
    _land(path, [{"id": i, "name": "x" * 50 + "}" * (i % 3)} for i in range(1000)], None)
    assert read_multiline_json(spark, path, S.COUNTRY).rdd.getNumPartitions() == 1
    tiny_splits(1 << 14)
    units = read_json_units(spark, path)
    tasks = spark.read.text(path, lineSep="}").rdd.getNumPartitions()
    tiny_splits(1 << 20)
    assert tasks >= os.path.getsize(path) // (1 << 14)
    assert units.count() == 1000
    assert units.select(F.countDistinct("id")).first()[0] == 1000


def test_a_giant_document_comes_in_small_units(spark, tmp_dir, tiny_splits):
    path = f"{tmp_dir}/giant.json"
    states = [{"id": s, "name": f"s{s}", "cities": [{"id": c, "name": "n" * 20} for c in range(100)]} for s in range(20)]
    _land(path, [{"id": 1, "name": "one", "states": states, "iso3": "ABC"}], None)
    tiny_splits(16384)
    units = read_json_units(spark, path, ("states", "cities"))
    pieces = read_location_pieces(spark, path)
    tiny_splits(1 << 20)
    sizes = {r["level"]: (r["n"], r["longest"]) for r in units.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("text")).alias("longest")).collect()}
    assert {k: n for k, (n, _) in sizes.items()} == {0: 1, 1: 20, 2: 2000}
    assert max(longest for _, longest in sizes.values()) < 100
    cities = flatten_cities(pieces["cities"], outer=False)
    assert cities.count() == 2000
    assert cities.where("country_id = 1 and country_code = 'ABC'").select("state_id").distinct().count() == 20


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": 2', '{"id": "a', '[{"id": 1}', '{"id": 1}}', "[1, 2]", "[[{}]]", '[{"id": [}]}]'])
def test_broken_files_raise(spark, tmp_dir, text):
    path = f"{tmp_dir}/broken.json"
    with open(path, "w") as f:
        f.write(text)
    with pytest.raises((ValueError, PySparkException)):
        read_json_ranges(spark, path, S.COUNTRY).collect()


def test_odd_files(spark, tmp_dir):
    path = f"{tmp_dir}/odd.json"
    for text, want in (("", 0), (" \n", 0), ("[]", 0), ("{}", 1), ("[ ]\n", 0), ('[{"id":1},\n{"id":2}]\n\n', 2), ('{"id":1}', 1), ('\n {"id":1}\n', 1)):
        with open(path, "w") as f:
            f.write(text)
        assert read_json_ranges(spark, path, S.COUNTRY).count() == want, text


def test_scratch_and_converted_files_are_zstandard(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from geonest.plans.location import convert_json_to_parquet
    from geonest.session import checkpoint_root

    spark.createDataFrame([('[{"id":1},\n{"id":2}]',)], "value string").coalesce(1).write.text(f"{tmp_dir}/raw")
    at = lambda p: {f for f in glob.glob(f"{p}/**/*.parquet".replace("file:", ""), recursive=True)}
    units = f"{checkpoint_root(spark)}/geonest/json-units-*"
    before = at(units)
    convert_json_to_parquet(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", S.COUNTRY, split_files=True)
    files = (at(units) - before) | at(f"{tmp_dir}/out")
    assert len(files) >= 3
    codecs = {m.row_group(0).column(0).compression for m in (pq.ParquetFile(f).metadata for f in files) if m.num_row_groups}
    assert codecs == {"ZSTD"} and spark.read.parquet(f"{tmp_dir}/out").count() == 2
