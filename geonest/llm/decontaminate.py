"""Benchmark decontamination (1): BM25 with block-max WAND.

The test items are the indexed documents, the passages of the training texts
are the queries. An item's BM25 weights are divided by its score against
itself, so one threshold serves items of any length: the share of an item's
weight that a passage holds. Retrieval is exact: every (passage, item) at or
above the threshold is found. A passage goes on only

1. if the maxima of its terms over all items add up to the threshold (the
   pivot of WAND),
2. for the blocks of items that hold one of its rarer terms and whose maxima
   for these, with the overall maxima of its common terms, do, and then
3. whose maxima for all of its terms do (block-max WAND).

Only the items of such blocks are scored. A hit counts if both the question
and the answer of the item overlap with the document's words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import pick, text_bytes, tidy, write_table

#: Words between the starts of two passages; a passage has twice as many.
STRIDE = 64
#: Words of an item that are indexed as one unit; a longer item is several.
UNIT = 64
#: Items with fewer words cannot be told from chance and are left out.
MIN_WORDS = 6
#: Share of a unit's BM25 weight that a passage must hold.
THRESHOLD = 0.6
#: Shares of the question's and the answer's words within shared word runs.
QUESTION, ANSWER = 0.6, 0.6
#: Last share of an item that stands for its answer, where the table has no answers.
ANSWER_SHARE = 0.25
RUN = 3
K1, B = 1.2, 0.75
#: Units per block of the index, and units of one index that the tasks hold.
BLOCK, SHARD = 8, 20_000
#: Documents, and about so many words, that are searched together.
DOCS, WORDS = 256, 400_000

_BREAKS = bytes(c for c in range(128) if not chr(c).isalnum())
_TABLE = bytes.maketrans(_BREAKS, b" " * len(_BREAKS))


def plain_words(text: bytes) -> list[bytes]:
    """Words of ASCII letters and digits and any other characters; the rest of
    ASCII parts words. Case is folded and composed as Unicode has it (NFC);
    bytes that are not UTF-8 stay as they are."""
    if text.isascii():
        return text.lower().translate(_TABLE).split()
    folded = normalize("NFC", normalize("NFC", text.decode("utf-8", "surrogateescape")).casefold())
    return folded.encode("utf-8", "surrogateescape").translate(_TABLE).split()


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start .. start + count - 1 of each, one after another."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Index:
    """A block-max index of units (lists of words) with the collection's
    document frequencies, size and mean length.

    Terms are numbered by falling number of blocks that hold them, so a
    passage's sorted terms come the most common first."""

    def __init__(self, units: list[list[bytes]], df: dict[bytes, int], n_units: int, mean: float):
        self.n_blocks = -(-len(units) // BLOCK)
        held: dict[bytes, set[int]] = {}
        for u, words in enumerate(units):
            for w in words:
                held.setdefault(w, set()).add(u // BLOCK)
        names = sorted(held, key=lambda w: (-len(held[w]), w))
        self.terms = {w: t for t, w in enumerate(names)}
        idf = np.array([np.log(1 + (n_units - df[w] + 0.5) / (df[w] + 0.5)) for w in names])
        rows = []
        for u, words in enumerate(units):
            t, tf = np.unique([self.terms[w] for w in words], return_counts=True)
            weight = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * tf.sum() / mean))
            rows.append((t, np.full(len(t), u), weight / max(weight.sum(), 1e-12)))
        # forward index: each unit's terms and weights
        self.unit_term, unit, self.unit_weight = (np.concatenate(c) for c in zip(*rows, strict=True))
        self.unit_count = np.bincount(unit, minlength=len(units))
        self.unit_start = np.cumsum(self.unit_count) - self.unit_count
        self.maximum = np.zeros(len(names))
        np.maximum.at(self.maximum, self.unit_term, self.unit_weight)
        # postings: each term's blocks and its largest weight in them
        self.post_key, at = np.unique(self.unit_term * self.n_blocks + unit // BLOCK, return_inverse=True)
        self.post_max = np.zeros(len(self.post_key))
        np.maximum.at(self.post_max, at, self.unit_weight)
        self.post_count = np.bincount(self.post_key // self.n_blocks, minlength=len(names))
        self.post_start = np.cumsum(self.post_count) - self.post_count

    def search(self, window: np.ndarray, term: np.ndarray, n_windows: int, threshold: float) -> list[tuple[int, int, float]]:
        """All (window, unit, score) at or above ``threshold``; (window, term)
        are distinct and sorted."""
        least, n_blocks = threshold - 1e-9, self.n_blocks
        top = self.maximum[term]
        keep = np.bincount(window, top, n_windows)[window] >= least  # the pivot test
        window, term, top = window[keep], term[keep], top[keep]
        if not len(window):
            return []
        count = np.bincount(window, minlength=n_windows)
        start = np.cumsum(count) - count
        # the most common terms, as far as their maxima stay below half the threshold, open no block
        run = np.cumsum(top)
        run -= (run - top)[start[window]]
        common = run <= threshold / 2
        shared = np.bincount(window[common], top[common], n_windows)
        n_common = np.bincount(window[common], minlength=n_windows)
        rare = ~common
        n = self.post_count[term[rare]]
        at = _spans(self.post_start[term[rare]], n)
        pair, where = np.unique(np.repeat(window[rare], n) * n_blocks + self.post_key[at] % n_blocks, return_inverse=True)
        bound = np.bincount(where, self.post_max[at], len(pair))
        good = bound + shared[pair // n_blocks] >= least
        pair, bound = pair[good], bound[good]
        # the common terms' own maxima in the blocks that are left
        win, block = pair // n_blocks, pair % n_blocks
        owner = np.repeat(np.arange(len(pair)), n_common[win])
        key = term[_spans(start[win], n_common[win])] * n_blocks + block[owner]
        at = np.minimum(np.searchsorted(self.post_key, key), len(self.post_key) - 1)
        bound += np.bincount(owner, np.where(self.post_key[at] == key, self.post_max[at], 0.0), len(pair))
        good = bound >= least
        win, block = win[good], block[good]
        # full scores of the units of these blocks
        last = np.minimum((block + 1) * BLOCK, len(self.unit_count))
        unit = _spans(block * BLOCK, last - block * BLOCK)
        win = np.repeat(win, last - block * BLOCK)
        owner = np.repeat(np.arange(len(unit)), self.unit_count[unit])
        at = _spans(self.unit_start[unit], self.unit_count[unit])
        held = window << 32 | term
        key = win[owner] << 32 | self.unit_term[at]
        found = held[np.minimum(np.searchsorted(held, key), len(held) - 1)] == key
        score = np.bincount(owner, np.where(found, self.unit_weight[at], 0.0), len(unit))
        good = score >= least
        return list(zip(win[good].tolist(), unit[good].tolist(), score[good].tolist(), strict=True))


def passages(ids: list[np.ndarray], stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (window, term) of the known terms of some documents, sorted,
    and each window's document and first word. A window starts every
    ``stride`` words and has twice as many."""
    n = [max(1, -(-len(x) // stride)) for x in ids]
    first = np.cumsum(n) - n
    keys = []
    for x, f in zip(ids, first, strict=True):
        at = np.flatnonzero(x >= 0)
        w = at // stride
        keys.append((f + w) << 32 | x[at])
        again = w > 0
        keys.append((f + w[again] - 1) << 32 | x[at[again]])
    distinct = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(ids)), n)
    return distinct >> 32, distinct & 0xFFFFFFFF, doc, (np.arange(len(doc)) - first[doc]) * stride


def overlap(part: list[bytes], runs: dict[int, set], size: int) -> float:
    """Share of the words of ``part`` that lie in word runs of the passage."""
    if not part:
        return 1.0
    size = min(size, len(part))
    hit = np.zeros(len(part), bool)
    for i in range(len(part) - size + 1):
        if tuple(part[i:i + size]) in runs[size]:
            hit[i:i + size] = True
    return float(hit.mean())


@dataclass
class Items:
    """What a task holds of the items: the index, each unit's item, and the
    items' ids, questions and answers."""

    index: Index
    unit_item: np.ndarray
    ids: list[int]
    questions: list[list[bytes]]
    answers: list[list[bytes]]


def _search(items: Items, threshold: float, question: float, answer: float):
    """Finds the hits of whole documents: (document number, item number,
    score, question overlap, answer overlap, position)."""
    known = items.index.terms

    def search(docs: list[list[bytes]]) -> list[tuple[int, int, float, float, float, int]]:
        ids = [np.fromiter(map(known.get, ws, repeat(-1)), np.int64, len(ws)) for ws in docs]
        window, term, doc, first = passages(ids)
        best: dict[tuple[int, int], tuple[float, list[int]]] = {}
        for win, unit, score in items.index.search(window, term, len(doc), threshold):
            key = int(doc[win]), int(items.unit_item[unit])
            had, places = best.get(key, (0.0, []))
            best[key] = max(had, score), [*places, int(first[win])]
        rows = []
        for (d, item), (score, places) in sorted(best.items()):
            q, a = items.questions[item], items.answers[item]
            reach = len(q) + len(a)
            near = docs[d][max(0, min(places) - reach):max(places) + 2 * STRIDE + reach]
            runs = {n: set(zip(*(near[k:] for k in range(n)))) for n in range(1, RUN + 1)}  # noqa: B905
            q_share, a_share = overlap(q, runs, RUN), overlap(a, runs, RUN)
            if q_share >= question and a_share >= answer:
                rows.append((d, item, score, q_share, a_share, min(places)))
        return rows

    def batch(texts: pa.Array) -> Iterator[tuple]:
        held, at, n = [], 0, 0
        for i, text in enumerate(texts):
            held.append(plain_words(text.as_py()))
            n += len(held[-1])
            if n >= WORDS or len(held) == DOCS or i == len(texts) - 1:
                for d, *rest in search(held):
                    yield at + d, *rest
                held, at, n = [], i + 1, 0

    return batch


@tidy
def _find(items: Items, *limits: float):
    search = _search(items, *limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(search(b.column(1)))
            if rows:
                d, item, score, q, a, place = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(d)), pa.array([items.ids[k] for k in item], pa.int64()), *(pa.array(x, pa.float64()) for x in (score, q, a)), pa.array(place, pa.int64())],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "position"],
                )

    return run


@tidy
def _drop(items: Items, *limits: float):
    search = _search(items, *limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[[row[0] for row in search(b.column(0))]] = False
            yield b.select(list(range(1, b.num_columns))).filter(pa.array(keep))

    return run


HITS = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double, position bigint"
_ITEM = "item_id bigint, question array<binary>, answer array<binary>, shard int, unit int, words array<binary>"


@tidy
def _items(answer_share: float, n_shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item_id, q, a in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                q, a = plain_words(q), plain_words(a or b"")
                if not a:
                    cut = len(q) - max(1, int(len(q) * answer_share))
                    q, a = q[:cut], q[cut:]
                words = q + a
                if len(words) < MIN_WORDS:
                    continue
                for unit, at in enumerate(range(0, len(words), UNIT)):
                    # a short last unit takes words from the one before
                    rows.append((item_id, q, a, item_id % n_shards, unit, words[max(0, min(at, len(words) - UNIT)):at + UNIT]))
            binary = pa.list_(pa.binary())
            kinds = [pa.int64(), binary, binary, pa.int32(), pa.int32(), binary]
            cols = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["item_id", "question", "answer", "shard", "unit", "words"])

    return run


def _shards(items: DataFrame) -> Iterator[Items]:
    """Indexes of about ``SHARD`` units each, with statistics over all items."""
    q = "question" if "question" in items.columns else "text"
    a = items["answer"].cast("string") if "answer" in items.columns else F.lit(None).cast("string")
    known = items.select(items["item_id"].cast("bigint").alias("item_id"), items[q].cast("string").alias("q"), a.alias("a"))
    one = F.min(F.struct(F.coalesce("q", F.lit("")).alias("q"), F.coalesce("a", F.lit("")).alias("a")))
    known = known.where("item_id is not null").groupBy("item_id").agg(one.alias("s"))
    known = known.select("item_id", F.col("s.q").cast("binary").alias("q"), F.col("s.a").cast("binary").alias("a"))
    size = known.agg(F.sum(F.length("q") + F.length("a"))).first()[0] or 0
    n_shards = max(1, -(-int(size) // (SHARD * UNIT * 6)))
    units = write_table(known.mapInArrow(_items(ANSWER_SHARE, n_shards), _ITEM), "units")
    whole = units.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).first()
    df = write_table(units.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df")), "units-df")
    for shard in range(n_shards):
        own = units.where(F.col("shard") == shard)
        rows = own.orderBy("item_id", "unit").collect()
        if not rows:
            continue
        counts = own.select(F.explode("words").alias("word")).distinct().join(df, "word").collect()
        first = {r["item_id"]: r for r in reversed(rows)}
        ids = sorted(first)
        number = {item_id: k for k, item_id in enumerate(ids)}
        yield Items(
            Index([[bytes(w) for w in r["words"]] for r in rows], {bytes(r["word"]): r["df"] for r in counts}, whole["n"], whole["mean"]),
            np.array([number[r["item_id"]] for r in rows]),
            ids,
            [[bytes(w) for w in first[k]["question"]] for k in ids],
            [[bytes(w) for w in first[k]["answer"]] for k in ids],
        )


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION, answer: float = ANSWER) -> DataFrame:
    """One row for each document of ``docs`` (``doc_id``, ``text``) and item of
    ``items`` (``item_id``, and ``text``, or ``question`` and ``answer``) that
    it gives away: ``score`` of its best passage, ``question_overlap`` and
    ``answer_overlap`` (shares of their words in runs of three words, or as
    many as there are), and ``position``, the word at which the first such
    passage starts.

    Defined cases: a null or empty text has no passages; items without an id,
    or with fewer than ``MIN_WORDS`` words, are left out; an item without an
    answer has its last quarter as one; an item id that repeats has its
    smallest text; rows that repeat a document's id give their best passage;
    a document without an id has null in its place; scores equal to the
    threshold count; an empty table gives no rows; other columns are ignored.

    The items are dealt to indexes of about ``SHARD`` units, whose statistics
    cover all items; every document is searched in each, in one pass over
    the texts per index, without a shuffle of texts.
    """
    d = pick(docs, doc_id="doc_id:bigint", text="text:string").withColumn("text", text_bytes("text"))
    found = d.limit(0).select("doc_id", F.lit(0).cast("bigint").alias("item_id"), *(F.lit(0.0).alias(c) for c in ("score", "question_overlap", "answer_overlap")), F.lit(0).cast("bigint").alias("position"))
    for shard in _shards(items):
        found = found.union(d.mapInArrow(_find(shard, threshold, question, answer), HITS))
    best = F.max_by(F.struct("score", "question_overlap", "answer_overlap", "position"), F.struct("score", "question_overlap", "answer_overlap", -F.col("position")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION, answer: float = ANSWER) -> DataFrame:
    """The rows of ``docs``, with all columns whatever their names, that give no
    item away; each is judged alone, so ids may be null or repeat."""
    # a name that no other column has
    searched = max(["searched", *docs.columns], key=len) + "_"
    for shard in _shards(items):
        d = docs.select(text_bytes("text").alias(searched), *(docs[c] for c in docs.columns))
        docs = d.mapInArrow(_drop(shard, threshold, question, answer), docs.schema)
    return docs
