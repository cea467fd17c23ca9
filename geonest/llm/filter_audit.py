r"""Filter interaction audit (11) by truth-table survival words.

Five filters give 32 subsets. A document that fails some filters survives
exactly the subsets that hold none of these; its 32-bit survival word has a
bit for each subset that it survives. How many documents of a group survive
each subset is the positional popcount of the group's words, taken with
carry-save adders: three words become a word of sums and a word of carries,
so counting is a few word operations for all 32 positions at once. Every
figure of every order of the filters follows from these 32 counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geonest.llm.common import UPPER, pick, write_table

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ORDERS = ["".join(o) for o in permutations(FILTERS)]
SPACE = r"[\x20\x09-\x0D]+"
#: Groups whose words a task holds at once, and words that it holds before they are counted.
GROUPS, WORDS = 1024, 1 << 20


def survival_words(fails: np.ndarray) -> np.ndarray:
    """The survival word of each mask of failed filters: bit s is set if mask and s share no filter."""
    subsets = np.arange(SUBSETS)
    table = [int(((m & subsets) == 0) @ (1 << subsets)) for m in range(SUBSETS)]
    return np.array(table, np.uint32)[fails]


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of ``words`` (uint32) have each bit set, by carry-save adders."""
    counts, weight = np.zeros(32, np.int64), 1
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            a, b, c, rest = words[:third], words[third:2 * third], words[2 * third:3 * third], words[3 * third:]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, rest])
        for w in words.tolist():  # at most two of each weight
            counts += weight * ((w >> np.arange(32)) & 1)
        words, weight = np.concatenate(carries) if carries else words[:0], 2 * weight
    return counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, good, toxic, fails) rows to one row of 32 counts per group and task, or more where a task has many groups."""
    held: dict[tuple, list[np.ndarray]] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        rows = [(*key, positional_popcount(np.concatenate(words)).tolist()) for key, words in held.items()]
        part, good, toxic, n = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array(good, pa.bool_()), pa.array(toxic, pa.bool_()), pa.array(n, pa.list_(pa.int64()))], ["part", "good", "toxic", "n"]
        )

    for b in batches:
        for at in range(0, b.num_rows, WORDS):
            t = pa.Table.from_batches([b.slice(at, WORDS)])
            words = survival_words(t.column("fails").to_numpy())
            code = t.column("part").combine_chunks().dictionary_encode()
            label = 2 * t.column("good").to_numpy().astype(np.int64) + t.column("toxic").to_numpy()
            key = 4 * code.indices.to_numpy().astype(np.int64) + label
            order = np.argsort(key, kind="stable")
            key, words = key[order], words[order]
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            for lo, hi in zip(heads, np.append(heads[1:], len(key)), strict=True):
                k = int(key[lo])
                held.setdefault((code.dictionary[k // 4].as_py(), bool(k & 2), bool(k & 1)), []).append(words[lo:hi])
            size += len(words)
            if size >= WORDS or len(held) >= GROUPS:
                yield flush()
                held, size = {}, 0
    if held:
        yield flush()


def fail_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    ws = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, distinct = F.size(ws), F.size(F.array_distinct(ws))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    failed = [n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * F.length(text), text.rlike(r"[#$%&*|]")]
    mask = F.lit(0)
    for i, f in enumerate(failed):
        mask = mask + F.when(f, 1 << i).otherwise(0)
    return mask


def document_fails(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``good``, ``toxic``, ``fails`` (bits of the failed
    filters, A the lowest) for every row of ``docs``.

    Texts are known by their SHA-256. The smallest id of each text passes E;
    these (id, text) pairs go back to the rows by id, so that a text held by
    any share of the rows is no hot key."""
    d = pick(docs, doc_id="doc_id:bigint", text="text:string", lang="lang:string")
    text = F.coalesce("text", F.lit(""))
    masked = write_table(
        d.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), fail_mask(text).alias("fails"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")),
        "audit-masks",
    )
    first = masked.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = (
        pick(labels, doc_id="doc_id:bigint", quality="quality:int", toxic="toxic:int").where("doc_id is not null")
        .groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    joined = masked.join(first.hint("merge"), ["doc_id", "digest"], "left").join(marks.hint("merge"), "doc_id", "left")
    copy = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 16).otherwise(0)
    return joined.select(
        "doc_id", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), (F.col("fails") + copy).alias("fails")
    )


def subset_survivors(fails: DataFrame) -> DataFrame:
    """``part``, and for all documents, the good and the toxic ones how many
    survive each of the 32 subsets: arrays ``n``, ``n_good``, ``n_toxic``."""
    counted = fails.select("part", "good", "toxic", "fails").mapInArrow(_count, "part string, good boolean, toxic boolean, n array<bigint>")
    each = counted.select("part", "good", "toxic", F.posexplode("n").alias("s", "n"))
    zero = F.lit(0)
    sums = each.groupBy("part", "s").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(zero)).alias("n_good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(zero)).alias("n_toxic")
    )
    rows = F.sort_array(F.collect_list(F.struct("s", "n", "n_good", "n_toxic")))  # 32 a part
    return sums.groupBy("part").agg(rows.alias("r")).select("part", "r.n", "r.n_good", "r.n_toxic")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    r"""One row per ``part`` (each ``lang``; null and empty: the empty string),
    ``filter_order`` (all orders of ABCDE) and ``step``, with document counts
    ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley`` (the filter's removals over all orders).

    A document (``docs``: ``doc_id``, ``text``, ``lang``) fails A with under
    100 words ``[^\x20\x09-\x0D]+``; B if under 80 % of its words are
    distinct; C if over 10 % of its code points are ``[A-Z]``; D if it holds
    any of ``#$%&*|``; E if a smaller doc_id has the same text. ``labels``
    (``doc_id``, ``quality``, ``toxic``) marks good and toxic ones.

    Defined cases: a null text is empty; rows that repeat an id count one by
    one, and none of them is a copy of another with its id; a row without an
    id is no copy and makes none; an id labelled more than once is good
    (toxic) if any of its rows says so; an empty table gives no rows; other
    columns are ignored."""
    survivors = write_table(subset_survivors(document_fails(docs, labels)), "audit-survivors")
    steps = survivors.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS)))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )

    def bit(place: str) -> str:
        return f"shiftleft(1, instr('{FILTERS}', substr(filter_order, {place}, 1)) - 1)"

    after = F.expr(f"aggregate(sequence(1, step), 0, (held, p) -> held | {bit('p')})")
    steps = steps.withColumn("after", after).withColumn("own", F.expr(bit("step"))).withColumn("before", F.col("after").bitwiseXOR(F.col("own")))

    def at(counts: str, subset: Column) -> Column:
        return F.get(counts, subset)

    def lost(counts: str) -> Column:
        return at(counts, F.col("before")) - at(counts, F.col("after"))

    whole = F.lit(SUBSETS - 1)
    rows = steps.select(
        "part", "filter_order", "step", "own",
        at("n", F.col("after")).alias("kept"),
        lost("n").alias("removed"),
        (at("n", F.lit(0)) - at("n", F.col("own")) - lost("n")).alias("redundant"),
        (at("n", whole.bitwiseXOR(F.col("own"))) - at("n", whole)).alias("unique_fails"),
        lost("n_good").alias("good_lost"),
        lost("n_toxic").alias("toxic_lost"),
    )
    orders = Window.partitionBy("part", "own")  # 120 rows
    return rows.withColumn("shapley", F.sum("removed").over(orders)).drop("own")
