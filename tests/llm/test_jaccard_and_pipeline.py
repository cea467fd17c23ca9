"""N-gram Jaccard join (6), connected components, and the corpus pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from geonest.llm import jaccard_join as J
from geonest.llm.components import connected_components
from geonest.llm.shingles import shingle_set

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_components(rows, percent=75, size=5):
    def shingles(t):
        ws = (t or "").encode().lower().split()
        k = min(size, len(ws))
        return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if ws else set()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


def edit(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def corpus(seed=0):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    rows, n = [], 0
    for length in (3, 5, 8, 12, 20, 40, 90, 200, 600):
        for _ in range(6):
            base = rng.choices(vocabulary, k=length)
            for copies in range(rng.randrange(1, 5)):
                words = edit(rng, base, rng.randrange(0, max(1, length // 14) + 1)) if copies else base
                rows.append((n, " ".join(words).upper() if copies == 2 else " ".join(words)))
                n += 1
    for _ in range(30):  # a passage that many share, and little else
        rows.append((n, " ".join(passage + rng.choices(vocabulary, k=rng.choice([2, 5, 20])))))
        n += 1
    chain = rng.choices(vocabulary, k=100)  # each near the next, the ends far apart
    for _ in range(8):
        rows.append((n, " ".join(chain)))
        chain = chain[2:] + rng.choices(vocabulary, k=2)
        n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)  # several blocks per signature
    rows = corpus(seed) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (None, "one"), (5005, "word " * 40_000), (5006, "word " * 30)]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, rep int, component string")
    got = sorted((tuple(r) for r in J.jaccard_components(df).collect()), key=repr)
    assert got == brute_components(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "A B C D E F G H"), (3, "z y x w v u t"), (3, "a b c d e f g h")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # rows that repeat an id are judged each by its own text
    assert sorted(tuple(r) for r in J.jaccard_components(df).collect()) == [(1, 4, 1), (1, 4, 1), (2, 4, 1), (3, 3, 3), (3, 4, 1)]
    assert J.jaccard_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 3])
def test_pairs_that_short_keys_suggest_wrongly(spark, bits):
    """Too few bits refute nothing: the components still are those of the whole features."""
    rows = corpus(2)[:120]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    groups = J.jaccard_groups(df, most_bits=bits).select("doc_id", "group").collect()
    label = dict(map(tuple, groups))
    want = {i: c for i, _, c in brute_components(rows)}
    lowest = {g: min(i for i in label if label[i] == g) for g in set(label.values())}
    assert {i: lowest[g] for i, g in label.items()} == want


def _tile(sets, components):
    """All members of one signature as one tile."""
    n = len(sets)
    columns = {
        "sig": [7] * n, "i": [0] * n, "j": [0] * n, "rep": list(range(n)), "component": components, "n": [len(s) for s in sets],
        "left": [True] * n, "right": [True] * n, "keys": [J.short_keys(s, 24) for s in sets],
    }
    return pa.RecordBatch.from_pydict(columns)


def test_a_tile_gives_fewer_pairs_than_members():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base, rng.integers(0, 1 << 63, 10, dtype=np.uint64)])) for _ in range(60)]
    pairs = [p for b in J._across(75, 24)(iter([_tile(sets, list(range(60)))])) for p in b.to_pylist()]
    assert len(pairs) == 59
    every = [p for b in J._across(75, 24, every=True)(iter([_tile(sets, list(range(60)))])) for p in b.to_pylist()]
    assert len({(p["a"], p["b"]) for p in every}) == 60 * 59 // 2


def test_short_keys_never_miss_a_shared_feature():
    rng = np.random.default_rng(3)
    for n in (1, 50, 3000, 40_000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, n, dtype=np.uint64)]))
        for most in (0, 9, 24):
            coded = [J.short_keys(x, most) for x in (a, b)]
            keys = J.read_keys([coded[0], coded[1], coded[0]])
            mask = [(1 << J.key_bits(len(x), most)) - 1 for x in (a, b)]
            want = [np.sort((x >> np.uint64(24)) & np.uint64(m)).astype(np.int64) for x, m in zip((a, b), mask, strict=True)]
            assert (keys == np.concatenate([want[0], want[1], want[0]])).all()
            low = min(mask)
            assert np.isin(want[0] & low, want[1] & low).sum() >= len(np.intersect1d(a, b))


@pytest.mark.parametrize("size", [1, 2, 3, 4, 7, 13, 50, 134, 400, 3000])
def test_similar_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for _ in range(60):
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        both = rng.integers(-(-size * 75 // 100), size + 1)  # kept of a; the rest of the allowance is added
        add = int(both * 100 // 75 - size)
        b = np.concatenate([a[:both], rng.integers(0, 1 << 63, rng.integers(0, max(add, 0) + 1), dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if J.similar(a, b):
            assert len(np.intersect1d(J.signatures(a), J.signatures(b)))
            assert np.abs(np.frombuffer(J.sketch(a), np.uint8).astype(int) - np.frombuffer(J.sketch(b), np.uint8)).sum() <= len(np.setxor1d(a, b))


def test_signatures_grow_with_the_set_only():
    for size in (20, 200, 2000, 20_000):
        a = np.unique(np.random.default_rng(size).integers(0, 1 << 63, size, dtype=np.uint64))
        assert len(J.signatures(a)) <= 2 * size + 40


def test_shingles():
    assert len(shingle_set(b"a b c d e f")) == 2 and len(shingle_set(b"a b")) == 1 and len(shingle_set(b" ")) == 0
    assert (shingle_set(b"A  b\tc\nD e") == shingle_set(b"a b c d e")).all()


def test_connected_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline --------------------------------------------------------------------------------


def test_stages_keep_the_columns_and_take_effect(spark, tmp_dir):
    item = "which river runs through the seven valleys of the north and ends in the grey salt lake"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    line = "this very line stands in far too many of the documents"
    text = lambda i, n=30: " ".join(f"w{chr(97 + (i + k) % 26)}{chr(97 + k % 23)}x" for k in range(n))
    rows = [(i, f"{text(5 * i)}\n{line}", "en", "s", 0) for i in range(6)]
    rows += [
        (20, text(100, 80), "en", "s", 0), (21, text(100, 80) + " end", "en", "s", 0), (30, f"{text(50)} {item} {text(60)}", "en", "s", 0),
        (40, None, "en", "s", 0), (41, "12 34", "en", None, None), (42, text(200, 3000), None, "s", 0), (None, text(70, 12), "en", "s", 0), (43, text(210, 15), "en", "s", 0), (43, text(210, 15), "en", "s", 0),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("extra", F.lit(1))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{tmp_dir}/{name.replace(' ', '-')}"
        stage(spark, docs, tmp_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    ids = lambda name: sorted((r.doc_id for r in seen[name].select("doc_id").collect()), key=repr)
    everything = sorted([r[0] for r in rows], key=repr)
    assert ids("language ID") == sorted([i for i in everything if i not in (40, 41)], key=repr)
    assert ids("line dedup") == ids("language ID")
    with_line = [r.doc_id for r in seen["line dedup"].where(F.col("text").contains(line)).collect()]
    assert with_line == [5] and all(r.n_chars == len(r.text) for r in seen["line dedup"].collect())
    assert ids("n-gram Jaccard join") == sorted([i for i in set(ids("line dedup")) if i != 21], key=repr)
    assert ids("benchmark decontamination") == [i for i in ids("n-gram Jaccard join") if i != 30]
    packed = seen["best-fit packing"].collect()
    assert {r.doc_id for r in packed} == set(ids("benchmark decontamination"))
    assert all(len(r.ids) == 4 * r.length for r in packed)


def test_rows_that_repeat_an_id_are_judged_each_by_its_own_text(spark, tmp_dir):
    text = lambda i: " ".join(f"k{i}v{j}" for j in range(30))
    rows = [(1, text(1)), (5, text(1) + " end"), (5, text(2)), (6, text(2) + " end"), (7, text(3)), (7, text(4)), (7, text(4)), (8, None), (8, ""), (None, text(1))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    kept = corpus_pipeline.near_duplicates(spark, docs, tmp_dir)
    assert kept.columns == corpus_pipeline.COLUMNS
    want = [(1, text(1)), (5, text(2)), (7, text(3)), (7, text(4)), (8, None), (8, ""), (None, text(1))]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_on_an_empty_table(spark, tmp_dir):
    for name, schema in (("documents", DOCS), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def test_entry_registers_the_queries():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= names


def test_a_worker_keeps_the_state_of_one_operator():
    from geonest.llm import common, hd_language

    common.drop_state("")
    hd_language._profiles(64, 3)
    common.worker_state("geonest.llm.packing", "path", dict)
    list(hd_language._learn(64, 3)(iter([])))
    assert [k[0] for k in common._STATE] == ["geonest.llm.hd_language"]
    common.drop_state("")
    assert not common._STATE


def test_stages_hand_texts_over_in_small_batches(spark):
    import corpus_pipeline

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(1, "some words", "en", "s", 10)], "doc_id long, text string, lang string, source string, n_chars long")
    try:
        corpus_pipeline.language(spark, docs, "")
        assert int(spark.conf.get(key)) == 2048
    finally:
        spark.conf.set(key, before)


def test_a_batch_of_a_stage_is_bounded_in_bytes(spark):
    import pyarrow as pa

    from geonest.llm.common import BATCH_BYTES, BATCH_ROWS, small_batches

    keys = [f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(k) for k in keys]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    try:
        small_batches(spark)
        long = spark.range(0, 1000, 1, 1).selectExpr("id", "repeat('x', 20000) as text")
        got = long.mapInArrow(sizes, "n long, bytes long").collect()
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
    assert sum(r.n for r in got) == 1000
    assert max(r.n for r in got) <= BATCH_ROWS and max(r.bytes for r in got) < BATCH_BYTES + 100_000
