"""Decontamination (1), CTW scoring (2), exact top-k (3)."""

import zlib
from collections import Counter
from math import exp, lgamma, log, log10, pi
from unicodedata import normalize

import numpy as np
import pytest
from pyspark.sql import functions as F

from geonest.llm import decontaminate as D
from geonest.llm.ctw import log_gamma, score_documents
from geonest.llm.topk import Search, search_embeddings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- decontamination -------------------------------------------------------------------


def brute_scores(units, windows):
    """BM25 shares of every (window, unit)."""
    n, mean = len(units), np.mean([len(u) for u in units])
    df = Counter(w for u in units for w in set(u))
    idf = {w: log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    weight = [{w: idf[w] * c * (D.K1 + 1) / (c + D.K1 * (1 - D.B + D.B * len(u) / mean)) for w, c in Counter(u).items()} for u in units]
    return {(i, k): sum(x for w, x in ws.items() if w in set(win)) / sum(ws.values()) for i, win in enumerate(windows) for k, ws in enumerate(weight)}


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.6])
def test_wand_finds_every_item_above_the_threshold(threshold):
    rng = np.random.default_rng(5)
    vocabulary = [f"t{int(x)}".encode() for x in rng.zipf(1.3, 4000) % 900]
    units = [[vocabulary[i] for i in rng.integers(0, 4000, rng.integers(6, 60))] for _ in range(150)]
    docs = [[vocabulary[i] for i in rng.integers(0, 4000, 300)] + units[k][: len(units[k]) * 3 // 4] for k in range(0, 150, 10)] + [[], [b"unknown"]]
    df = Counter(w for u in units for w in set(u))
    index = D.Index(units, df, len(units), float(np.mean([len(u) for u in units])))
    ids = [np.array([index.terms.get(w, -1) for w in d], np.int64) for d in docs]
    window, term, doc, first = D.passages(ids)
    got = {(w, u): s for w, u, s in index.search(window, term, len(doc), threshold)}
    windows = [docs[d][f:f + 2 * D.STRIDE] for d, f in zip(doc, first, strict=True)]
    want = {k: s for k, s in brute_scores(units, windows).items() if s >= threshold - 1e-9}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert want


def items_frame(spark):
    text = "What is the tallest hill in the flat land of Nowhere? It is the small heap behind the old mill"
    return spark.createDataFrame([(1, text), (1, text + " x"), (2, "short one"), (3, None), (None, text + " more words here"), (4, " ".join(f"long{i}" for i in range(200)))], "item_id long, text string"), text


def test_contaminated_documents(spark):
    items, text = items_frame(spark)
    filler = " ".join(f"filler{i} the of in" for i in range(60))
    long_item = " ".join(f"long{i}" for i in range(200))
    rows = [
        (10, f"{filler} {text.upper()} {filler}"), (11, text.replace(" ", " ** ")), (12, filler), (13, " ".join(text.split()[:8])), (14, ""), (15, None),
        (16, " ".join(reversed(text.split()))), (17, f"{filler} {long_item}"), (18, " ".join(long_item.split()[:100])), (10, text), (None, text), (19, (filler + " ") * 300 + text),
    ]
    docs = spark.createDataFrame([(i, t, "e", "s", 1) for i, t in rows], "doc_id long, text string, item_id string, score string, shard long")
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    assert got == {(10, 1), (11, 1), (17, 4), (None, 1), (19, 1)}
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [12, 13, 14, 15, 16, 18]
    assert D.contaminated(docs.limit(0), items).count() == 0 and D.contaminated(docs, items.limit(0)).count() == 0
    assert D.drop_contaminated(docs, items.limit(0)).count() == len(rows)
    clash = docs.withColumn("_searched_text", F.col("doc_id"))
    kept = D.drop_contaminated(clash, items)
    assert kept.columns == clash.columns and sorted(r["_searched_text"] for r in kept.collect()) == [12, 13, 14, 15, 16, 18]


def test_question_alone_is_no_leak_and_shards_agree(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"question number q{i} about a{i} b{i} c{i} d{i}", f"the answer z{i} y{i} x{i}") for i in range(40)], "item_id long, question string, answer string")
    docs = spark.createDataFrame([(i, f"intro words question number q{i} about a{i} b{i} c{i} d{i} then " + (f"the answer z{i} y{i} x{i}" if i % 2 else "nothing")) for i in range(40)], "doc_id long, text string")
    whole = sorted(tuple(r) for r in D.contaminated(docs, items, threshold=0.3).collect())
    assert [r[0] for r in whole] == list(range(1, 40, 2)) and all(r[0] == r[1] for r in whole)
    monkeypatch.setattr(D, "SHARD", 1)
    parted = sorted(tuple(r) for r in D.contaminated(docs, items, threshold=0.3).collect())
    assert len(parted) == len(whole) and np.allclose(np.array(parted, float), np.array(whole, float))


def test_items_planted_in_the_documents_are_found(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    norm = lambda t: b" " + b" ".join(D.plain_words(t.encode())) + b" "
    held = [(r.item_id, norm(r.text)) for r in items.collect()]
    verbatim = {(d.doc_id, i) for d in docs.collect() for i, t in held if t in norm(d.text)}
    assert verbatim and verbatim <= found


def test_upper_cased_and_decomposed_copies_of_accented_items_are_found(spark):
    text = "El añejo camión cruzó la región más fría y la nación pidió atención según la opinión del señor Núñez und die Straße"
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    copies = [text.upper(), normalize("NFD", text), normalize("NFD", text.upper()), text.lower(), "nothing of the kind " * 8]
    docs = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.answer_overlap for r in D.contaminated(docs, items).collect()}
    assert got == {(i, 1): 1.0 for i in range(4)}
    assert [r.doc_id for r in D.drop_contaminated(docs, items).collect()] == [4]
    assert D.plain_words(b"A\xff\xc9 b") == [b"a\xff\xc9", b"b"]


# --- context-tree weighting ---------------------------------------------------------------


def brute_ctw(train, depth):
    count = {}
    for t in train:
        b = b"\xff" * depth + t + b"\xff"
        for p in range(depth, len(b)):
            for k in range(8):
                node, bit = (1 << k) | (b[p] >> (8 - k)), (b[p] >> (7 - k)) & 1
                for d in range(depth + 1):
                    count.setdefault((node, b[p - d:p]), [0, 0])[bit] += 1
    kt = lambda c: lgamma(c[0] + 0.5) + lgamma(c[1] + 0.5) - lgamma(sum(c) + 1) - log(pi)
    pw, sums = {}, Counter()
    for node, ctx in sorted(count, key=lambda x: -len(x[1])):
        own = kt(count[node, ctx])
        pw[node, ctx] = own if len(ctx) == depth else np.logaddexp(log(0.5) + own, log(0.5) + sums[node, ctx])
        if ctx:
            sums[node, ctx[1:]] += pw[node, ctx]

    def guess(node, bit, ctx, d, last):
        key = node, ctx[depth - d:] if d else b""
        c = count.get(key)
        if c is None:
            return last
        g = (c[bit] + 0.5) / (sum(c) + 1)
        if d == depth:
            return g
        stop = exp(log(0.5) + kt(c) - pw[key])
        return stop * g + (1 - stop) * guess(node, bit, ctx, d + 1, g)

    def score(t):
        b = b"\xff" * depth + t + b"\xff"
        return sum(log10(guess((1 << k) | (b[p] >> (8 - k)), (b[p] >> (7 - k)) & 1, b[p - depth:p], 0, 0.5)) for p in range(depth, len(b)) for k in range(8))

    return score


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 1e3, 1e9])
    assert np.allclose(log_gamma(x), [lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("depth,chunk", [(2, 1 << 20), (5, 600)])
def test_ctw_equals_brute_force(spark, depth, chunk):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["The", "cat", "ñu", "sat,", "on", "a", "mat\n"], rng.integers(0, 25))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (3, "twice a"), (None, "the cat"), (102, "unseen ZZZ 日本")]
    docs = spark.createDataFrame([(i, t, "e", "s", 1) for i, t in rows], "doc_id long, text string, gram string, word string, n long")
    got = sorted((tuple(r) for r in score_documents(docs, depth=depth, chunk_bytes=chunk).collect()), key=repr)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    train = [(t or "").encode() for i, t in rows if not held(i)]
    score = brute_ctw(train, depth)
    count = Counter(w for t in train for w in [*t.lower().split(), b""])
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        t = (t or "").encode()
        ws = [*t.lower().split(), b""]
        base = sum(log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        s = score(t)
        want.append((i, held(i), len(ws), sum(count[w] > 0 for w in ws), n, base, s, len(t), -s * np.log2(10) / (len(t) + 1)))
    want.sort(key=repr)
    assert [w[:5] for w in want] == [g[:5] for g in got]
    assert np.allclose([w[5:] for w in want], [g[5:] for g in got], rtol=1e-8)


def test_ctw_next_byte_probabilities_sum_to_one():
    from geonest.llm import ctw

    train = [b"ab", b"abc", b"b", b"", b"cab"] * 3
    depth, ctx = 2, b"ab"
    keys = np.concatenate([ctw.grams(t, depth) for t in train])
    # every next byte (0xFF is the end) after one context, asked for with no count of its own
    asked = np.array([ctx[1] << 16 | ctx[0] << 8 | b for b in range(256)])
    distinct = np.unique(np.concatenate([keys, asked]))
    n = np.array([(keys == k).sum() for k in distinct])
    batch = lambda: iter([ctw.pa.RecordBatch.from_arrays([ctw.pa.array(distinct), ctw.pa.array(n)], ["gram", "n"])])
    rows = [r for b in ctw._summaries(depth)(batch()) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    ids, top = ctw._top(rows)
    found = {k: v for b in ctw._gram_scores(depth, ids, top)(batch()) for k, v in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    assert abs(sum(10 ** found[k] for k in asked.tolist()) - 1) < 1e-9


def test_ctw_beats_words_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = score_documents(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b", "sum(n_bytes) n").first()
    assert got.s > got.b and -got.s * np.log2(10) / got.n < 3


# --- exact top-k ------------------------------------------------------------------------------


def brute_top(rows, every=50, k=5):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        vectors[i] = min(vectors[i], q) if i in vectors else q
    out = []
    for i, q in vectors.items():
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors.items() if j != i)  # noqa: B905
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 0.2, 16).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # equal vectors
    rows += [(2000, None), (2050, [None] + [0.1] * 15), (2100, [float("nan")] * 16), (2150, [float("inf")] * 16), (None, [0.1] * 16), (2200, []), (2250, [0.5] * 9), (50, rng.normal(0, 0.2, 16).tolist()), (0, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, v int")
    assert sorted(tuple(r) for r in search_embeddings(df).select("query_id", "rank", "vec_id", "score").collect()) == brute_top(rows)
    assert search_embeddings(df.limit(0)).count() == 0
    few = df.where("vec_id in (0, 1, 2)")
    assert search_embeddings(few).count() == 2


def test_queries_in_sets_and_large_values(spark, monkeypatch):
    import geonest.llm.topk as T

    monkeypatch.setattr(T, "QUERIES", 3)
    rows = [(i, [float(3e6 * np.sin(i + j)) for j in range(4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in search_embeddings(df, every=20).collect()) == brute_top(rows, 20)


def test_blocks_are_skipped():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (20, 8))
    blocks = []
    for b in range(200):
        rows = np.floor(centres[b % 20] + rng.normal(0, 10, (64, 8))).astype(np.int64)
        blocks.append((np.arange(64) + 64 * b, rows, np.maximum(np.concatenate([rows.max(0), (-rows).max(0)]), 0)))
    s = Search(np.array([-1]), np.floor(centres[3:4]).astype(np.int64), 5)
    s.add(blocks)
    scores = np.concatenate([b[1] @ s.queries[0] for b in blocks])
    assert s.best[0][1].tolist() == sorted(scores, reverse=True)[:5] and s.scored < 60


def test_chunks_are_cut_into_the_grams_and_words_of_each_text(monkeypatch):
    from geonest.llm import ctw

    monkeypatch.setattr(ctw, "SLICE", 7)
    texts = [b"", b"a", " Été\t the The\n".encode(), b"", b"\x0b" * 9, b"the end" * 5, "\u2003x".encode()]
    for depth in (2, 5):
        padded = ctw.pa.array([bytes([ctw.PAD]) * depth + t + bytes([ctw.PAD]) for t in texts], ctw.pa.binary())
        for span in ((0, 1 << 62), (0, 0x6400 << 8 * (depth - 1)), (0x6400 << 8 * (depth - 1), 1 << 62)):
            got = sorted((int(d), int(k)) for keys, docs in ctw._slices(padded, depth, span) for k, d in zip(keys, docs, strict=True))
            assert got == sorted((i, k) for i, t in enumerate(texts) for k in ctw.grams(t, depth).tolist() if span[0] <= k < span[1])
        names, at, ends = ctw._words(padded, depth)
        assert [[names[k] for k in at[lo:hi]] for lo, hi in zip(ends, ends[1:], strict=False)] == [t.lower().split() for t in texts]


def test_a_chunk_is_held_by_pieces(monkeypatch):
    """Short lists and pieces change what is held at once, not what comes out."""
    from geonest.llm import ctw

    rng = np.random.default_rng(4)
    depth, chunk_bytes = 5, 3000
    texts = [b"", b"x" * 2500, *(" ".join(rng.choice(["The", "the", "cat", "ñu", "a\n", "Zz"], rng.integers(0, 40))).encode() for _ in range(150)), b"new words"]
    held_out = [i % 7 == 0 for i in range(len(texts))]
    padded = [bytes([ctw.PAD]) * depth + t + bytes([ctw.PAD]) for t in texts]
    docs = [ctw.pa.RecordBatch.from_arrays([ctw.pa.array(range(a, a + len(padded[a:a + 60]))), ctw.pa.array(held_out[a:a + 60]), ctw.pa.array(padded[a:a + 60], ctw.pa.binary())], schema=ctw._DOC) for a in range(0, len(texts), 60)]
    task = type("Task", (), {"get": lambda: type("Task", (), {"partitionId": lambda self: 3})()})
    for name, value in (("PIECE_BYTES", 500), ("HELD", 40), ("SLICE", 64), ("BATCH", 50), ("TaskContext", task)):
        monkeypatch.setattr(ctw, name, value)
    rows = ctw.pa.Table.from_batches(ctw._bundle(chunk_bytes, depth)(iter(docs))).to_pylist()
    pieces = [r for r in rows if r["docs"] is not None]
    sizes = [[len(t) for t in ctw._read(ctw.pa.py_buffer(r["docs"])).column(2).to_pylist()] for r in pieces]
    assert sum(map(len, sizes)) == len(texts) and all(sum(s[:-1]) < 500 for s in sizes)
    assert len({r["chunk"] for r in rows}) > 1
    asked = [(r["chunk"], r["gram"]) for r in rows if r["gram"] is not None]
    assert len(set(asked)) < len(asked)  # a full list was asked for and begun anew
    grams, words = Counter(), Counter()
    for r in rows:
        if r["gram"] is not None:
            grams[r["gram"]] += r["n"]
        elif r["docs"] is None:
            words[r["word"]] += r["n"]
    train = [t for t, h in zip(texts, held_out, strict=True) if not h]
    assert +grams == Counter(k for t in train for k in ctw.grams(t, depth).tolist())
    assert +words == Counter(w for t in train for w in [*t.lower().split(), b""])
    n, v = sum(words.values()), len(+words)
    value = lambda k: -1 - k % 1009 / 1009
    got = {}
    for chunk in {r["chunk"] for r in rows}:
        own = [r for r in rows if r["chunk"] == chunk]
        items = [(False, r["gram"], value(r["gram"])) if r["gram"] is not None else (True, r["place"], float(words[r["word"]])) for r in own if r["docs"] is None]
        parts = [[np.full(len(x), chunk), *(np.array(c) for c in zip(*x, strict=True))] for x in (items[1::2], items[0::2])]
        packed = ctw.pa.Table.from_batches([ctw._packed([p]) for p in parts])
        stored = [r for r in own if r["docs"] is not None][::-1]
        table = ctw.pa.table({"chunk": [chunk] * len(stored), "place": [r["place"] for r in stored], "docs": ctw.pa.array([r["docs"] for r in stored], ctw.pa.binary())})
        got |= {r["doc_id"]: r for r in ctw._apply(depth, n, v)(table, packed).to_pylist()}
    for i, t in enumerate(texts):
        tokens = [*t.lower().split(), b""]
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["n_bytes"]) == (held_out[i], len(tokens), sum(words[w] > 0 for w in tokens), len(t))
        assert np.allclose([r["score"], r["base_score"]], [sum(value(k) for k in ctw.grams(t, depth).tolist()), sum(log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)])


def test_long_contexts_are_worked_out_in_parts(monkeypatch):
    from geonest.llm import ctw

    rng = np.random.default_rng(6)
    text = "".join(rng.choice(["e a", "e b", "e", " ", "ab", "ñ"], 4000)).encode()
    for depth in (2, 3, 5):
        keys, n = np.unique(ctw.grams(text, depth), return_counts=True)
        n[::5] = 0  # asked for by texts that do not teach
        batches = lambda: iter([ctw.pa.RecordBatch.from_arrays([ctw.pa.array(keys[a:a + 9]), ctw.pa.array(n[a:a + 9])], ["gram", "n"]) for a in range(0, len(keys), 9)])  # noqa: B023, E731

        def scores():
            rows = [r for b in ctw._summaries(depth)(batches()) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]  # noqa: B023
            summed = Counter()
            for key, bit, value in rows:
                summed[key, bit] += value
            out = list(ctw._gram_scores(depth, *ctw._top([(*k, v) for k, v in summed.items()]))(batches()))  # noqa: B023
            return np.concatenate([b.column(0).to_numpy() for b in out]), np.concatenate([b.column(1).to_numpy() for b in out]), max(b.num_rows for b in out)

        want_keys, want, longest = scores()
        assert longest == len(keys) and want_keys.tolist() == keys.tolist()
        with monkeypatch.context() as m:
            m.setattr(ctw, "BATCH", 20)
            got_keys, got, longest = scores()
        assert got_keys.tolist() == keys.tolist() and np.allclose(got, want, rtol=1e-11)
        context = np.unique(keys >> 8 * max(depth - 2, 1), return_counts=True)[1].max()
        assert longest <= 40 + context
