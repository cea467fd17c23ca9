"""Filter audit, conversation repair and SentencePiece against brute force."""

import hashlib
import heapq
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from geonest.llm.conversation_repair import Repair, damage, repair_conversations, summarise_repairs
from geonest.llm.filter_audit import ORDERS, audit_filters, document_fails, positional_popcount, survival_words
from geonest.llm.piece_bpe import PieceModel, decode_pieces, encode_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
@settings(deadline=None)
def test_popcount_by_carry_save(words):
    want = [sum(w >> i & 1 for w in words) for i in range(32)]
    assert positional_popcount(np.array(words, np.uint32)).tolist() == want


def test_survival_word_has_a_bit_per_survived_subset():
    word = int(survival_words(np.array([0b101]))[0])
    assert [s for s in range(32) if word >> s & 1] == [s for s in range(32) if not s & 0b101]


DOCS = "doc_id long, text string, lang string, n_chars string"


def _brute_audit(docs, labels):
    def fails(i, text):
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        return {
            "A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in docs),
        }

    judged = [(lang or "", i, fails(i, text or "")) for i, text, lang in docs]
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    out = set()
    for part in {p for p, _, _ in judged}:
        mine = [(i, f) for p, i, f in judged if p == part]
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in ORDERS:
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[x]]
                left = [(i, f) for i, f in left if not f[x]]
                shapley[x] += len(gone)
                alone = sum(f[x] and sum(f.values()) == 1 for _, f in mine)
                rows.append((order, step, x, len(left), len(gone), sum(f[x] for _, f in mine) - len(gone), alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out |= {(part, o, s, *rest, shapley[x]) for o, s, x, *rest in rows}
    return out


def test_audit_matches_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "a b c", "LOUD " * 50, " ".join(f"w{i}" for i in range(120)), " ".join(f"w{i}" for i in range(120)) + " #", "same " * 130, "x\x0b\ty $"]
    docs = [(rng.choice([None, *range(25)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(60)]
    labels = [(rng.randrange(30), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(25)] + [(None, 1, 1)]
    df = spark.createDataFrame([(*d, "clash") for d in docs], DOCS).withColumnRenamed("n_chars", "fails").repartition(3)
    got = audit_filters(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == columns
    assert {tuple(r) for r in got.collect()} == _brute_audit(docs, labels)
    assert got.count() == 600 * len({d[2] or "" for d in docs})


def test_audit_of_nothing_and_of_a_hot_text(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(spark.createDataFrame([], "doc_id long, text string, lang string"), labels).count() == 0
    hot = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same', cast(id AS string)) AS text", "'en' AS lang")
    fails = document_fails(hot, labels)
    assert fails.where("fails & 16 <> 0").count() == 1666
    assert fails.where("fails & 16 = 0 and doc_id = 0").count() == 1


def _cheapest(rows):
    """Dijkstra over (rows done, state) with (cost, audit) as the distance."""
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, n, state, out = heapq.heappop(queue)
        if (n, state) in done:
            continue
        done.add((n, state))
        if n == len(rows) and state in ("", "a"):
            return cost, audit, out
        ways = []
        for role, name in (("u", "user"), ("a", "assistant")):
            if (state, role) in legal:
                ways.append((2, "I", n, role, ((name, ""),)))
        if n < len(rows):
            role, text, fault = rows[n]
            ways.append((3, "D", n + 1, state, ()))
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                if (state, role[:1]) in legal:
                    ways.append((cut, "K", n + 1, role[:1], ((role, text),)))
                for r, name in (("u", "user"), ("a", "assistant")):
                    if (state, r) in legal:
                        ways.append((2 + cut, "R", n + 1, r, ((name, text),)))
        for extra, letter, m, to, more in ways:
            heapq.heappush(queue, (cost + extra, audit + letter, m, to, out + more))


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def _searched(rows):
    search = Repair()
    edits = [e for r in rows for e in search.add(r[0][:1], r[2], (None, *r))]
    edits += search.end()
    return "".join(e for e, _, _ in edits), tuple((role, row[2] if row else "") for e, role, row in edits if e != "D")


ROLES = ["system", "user", "assistant", "tool", "", " "]


@given(st.lists(st.tuples(st.sampled_from(ROLES), st.sampled_from(["", "a.", "b", "c!"])), max_size=9))
@settings(deadline=None, max_examples=400)
def test_search_finds_the_cheapest_and_least_edits(rows):
    rows = _faults(rows)
    cost, audit, out = _cheapest(rows)
    assert _searched(rows) == (audit, out)


def test_every_short_conversation_of_plain_rows():
    for n in range(6):
        for roles in itertools.product("suat", repeat=n):
            rows = [(r, f"{i}.", "") for i, r in enumerate(roles)]
            assert _searched(rows) == _cheapest(rows)[1:]


def test_search_holds_only_what_is_unsettled():
    search, most = Repair(), 0
    for i in range(20_000):
        search.add("ua"[i % 2], "", (i, "user" if i % 2 == 0 else "assistant", "x.", ""))
        most = max(most, search.held())
    assert most <= 8


def test_a_long_run_of_one_role_stays_exact():
    rows = [("user", f"{i}.", "") for i in range(301)]
    assert _searched(rows)[0] == _cheapest(rows)[1]


def _brute_summaries(rows, ids):
    out = set()
    for c in ids:
        mine = sorted(((t, r, x) for k, t, r, x in rows if k == c), key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))
        judged = _faults([(r, x) for _, r, x in mine])
        turns = {t for t, _, _ in mine if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        cost, audit, kept = _cheapest(judged)
        text = "\n".join(f"{r}:{x}" for r, x in kept)
        out.add((
            c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        ))
    return out


def test_repair_of_damaged_conversations(spark):
    rng = random.Random(5)
    texts = ["Yes.", "no", "", " \t", "Was?\n", None, "é…"]
    rows = list({
        (rng.choice([None, 1, 2, 3, 40]), rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", None]), rng.choice(texts)): 0 for _ in range(60)
    })
    conversations = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, earlier string").repartition(4)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    got = summarise_repairs(repair_conversations(conversations, conversations))
    assert {tuple(r) for r in got.collect()} == _brute_summaries(plain, {r[0] for r in rows})
    damaged = damage(conversations)
    hurt = [tuple(r) for r in damaged.collect()]
    got = summarise_repairs(repair_conversations(damaged, conversations))
    assert {tuple(r) for r in got.collect()} == _brute_summaries(hurt, {r[0] for r in rows})


def test_repeated_rows_and_empty_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yo.")], schema)
    ids = spark.createDataFrame([(1,), (2,)], "conv_id long")
    got = {r["conv_id"]: r for r in summarise_repairs(repair_conversations(rows, ids)).collect()}
    assert got[1]["audit"] == "KDK" and got[1]["duplicate"] == 1
    assert got[2]["audit"] == "" and got[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    empty = spark.createDataFrame([], schema)
    assert summarise_repairs(repair_conversations(empty, empty)).count() == 0
    edits = [(r["edit"], r["role"], r["text"], r["fault"]) for r in repair_conversations(rows).collect()]
    assert edits == [("K", "user", "Hi.", ""), ("D", None, None, "duplicate"), ("K", "assistant", "Yo.", "")]


@pytest.fixture(scope="module")
def model():
    return PieceModel(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _ids(own, text):
    return np.frombuffer(own.encode(text), "<i4").tolist()


def test_side_by_side_joining_agrees_with_joining_the_whole(model):
    own, _ = model
    rng = random.Random(4)
    pieces = [i for i, t in enumerate(own.texts) if t in own.id and own._steps(i) is not None]
    for _ in range(20_000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        whole = own.merge(own.texts[a] + own.texts[b])[0] == [own.texts[a], own.texts[b]]
        assert own.may_follow(a, b) == whole, (own.texts[a], own.texts[b])


ALPHABET = list("  aeinorst.,;()'▁\n\t_0179ABÉéßжи中文😀²×<s>\x00‍")


@given(text=st.one_of(st.text(st.sampled_from(ALPHABET), max_size=80), st.text(max_size=40)))
@settings(deadline=None, max_examples=600, derandomize=True)
def test_pieces_are_those_of_the_library(model, text):
    own, library = model
    text = text.encode("utf-8", "replace").decode()
    ids = library.encode(text)
    assert _ids(own, text) == ids
    assert own.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("text", [" " * 3000 + "x", "a" * 5000, "中" * 3000, "ab" * 4000, "=" * 5000, "x\n" * 2000])
def test_long_units(model, text):
    own, library = model
    assert _ids(own, text) == library.encode(text)
    assert own.decode(_ids(own, text)) == text


def test_any_ids_decode_as_in_the_library(model):
    own, library = model
    rng = random.Random(2)
    for _ in range(5000):
        ids = [rng.randrange(400) if rng.random() < 0.6 else rng.randrange(32000) for _ in range(rng.randrange(9))]
        assert own.decode(ids) == library.decode(ids)


def test_a_piece_may_follow_only_as_joining_has_it(model):
    own, library = model
    for text in ("▁the", "▁then", "ation", "▁ation"):
        assert own.merge(text)[0] == [library.id_to_piece(i) for i in own.encode_run(text)]


def test_piece_queries_on_odd_rows(spark, model):
    rows = [(1, None, "x"), (1, "", "x"), (None, "Hello  world\n", "x"), (7, "¡Hola! 中", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = decode_pieces(encode_pieces(docs, MODEL), MODEL).collect()
    want = [(i, model[1].encode(t or ""), t or "") for i, t, _ in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert encode_pieces(docs.limit(0), MODEL).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert decode_pieces(nulls, MODEL).first()["text"] == ""
