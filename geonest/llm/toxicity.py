"""Toxicity (4): a character n-gram classifier scaled by naive Bayes.

A text's features are its distinct character n-grams, hashed into a fixed
number of buckets and scaled by the naive Bayes log-count ratio of the
bucket. A logistic regression over all of them gives the score; its ridge is
the weaker, the more evidence the labelled rows hold on a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import id_remainder, pick, write_table

SIZES = (4, 5, 6)
BUCKETS = 1 << 18
#: A fitted row with fewer distinct buckets is held as a list of 16-bit numbers, else as a bitmap (``BUCKETS`` / 8 bytes at most).
FEATURES = BUCKETS // 16 - 8
#: Labelled rows that the regression is fitted on, about; the log-count
#: ratios are counted over all labelled rows.
FIT_ROWS = 10_000
#: Code points hashed at once.
CHUNK = 1 << 19
#: Buckets of the fitted rows that are unpacked at once.
UNPACKED = 1 << 21
#: Steps of the regression, steps it remembers, share of the first gradient at which it ends, and its ridge.
ROUNDS, MEMORY, ENOUGH, RIDGE = 40, 8, 1e-4, 100.0


def gram_buckets(text: str, sizes: tuple[int, ...] = SIZES, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a lower-cased text, one after another, in
    chunks that overlap so that no n-gram is lost."""
    longest = max(sizes)
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), "<u4")
    for at in range(0, len(codes), CHUNK):
        part = codes[at:at + CHUNK + longest - 1].astype(np.uint64)
        h = np.zeros(len(part), np.uint64)
        for n in range(1, longest + 1):
            m = len(part) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1:n - 1 + m] + np.uint64(n)
            if n in sizes:
                x = h[:CHUNK]
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                yield ((x >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _distinct(text: str) -> np.ndarray:
    found = list(gram_buckets(text))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per bucket and label; bucket -1 counts the documents."""
    n = np.zeros((2, BUCKETS + 1), np.int64)
    for b in batches:
        for text, label in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            n[label, _distinct(text.as_py())] += 1
            n[label, BUCKETS] += 1
    at = np.flatnonzero(n.sum(0))
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at == BUCKETS, -1, at)), pa.array(n[0, at]), pa.array(n[1, at])], ["bucket", "clean", "toxic"])


def pack_row(found: np.ndarray) -> bytes:
    """Distinct sorted buckets: how many there are in each 65,536, and their low 16 bits; or a bitmap."""
    if len(found) >= FEATURES:
        held = np.zeros(BUCKETS, bool)
        held[found] = True
        return np.packbits(held).tobytes()
    return np.bincount(found >> 16, minlength=BUCKETS >> 16).astype("<i4").tobytes() + (found & 0xFFFF).astype("<u2").tobytes()


def unpack_row(packed: bytes) -> np.ndarray:
    if len(packed) == BUCKETS // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8))).astype(np.int32)
    parts = BUCKETS >> 16
    high = np.repeat(np.arange(parts, dtype=np.int32) << 16, np.frombuffer(packed, "<i4", parts))
    return high | np.frombuffer(packed, "<u2", offset=4 * parts)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [pack_row(_distinct(t.as_py())) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], ["doc_id", "label", "buckets"])


@dataclass
class ToxicityModel:
    """The weight of each bucket and the bias."""

    weights: np.ndarray
    bias: float


def log_count_ratios(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """log of each bucket's share of the toxic counts over its share of the clean ones, add-one smoothed."""
    p, q = toxic + 1.0, clean + 1.0
    return np.log((p / p.sum()) / (q / q.sum()))


def fit_logistic(rows: list[bytes], labels: np.ndarray, weight: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of all buckets, whose values in a row that has them are
    ``value``, and bias: the ridge regression's minimum over packed rows, by
    L-BFGS. Only ``UNPACKED`` buckets or so are unpacked at once."""
    share = weight / max(weight.sum(), 1e-9)
    ridge = RIDGE / max(len(rows), 1)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        own, bias = x[:-1] * value, x[-1]
        total, grad, of_bias = 0.0, np.zeros(BUCKETS), 0.0
        at = 0
        while at < len(rows):
            cols, size, first = [], 0, at
            while at < len(rows) and size < UNPACKED:
                cols.append(unpack_row(rows[at]))
                size += len(cols[-1])
                at += 1
            count = [len(c) for c in cols]
            col = np.concatenate(cols)
            z = np.bincount(np.repeat(np.arange(len(cols)), count), own[col], len(cols)) + bias
            y, part = labels[first:at], share[first:at]
            total += float((part * (np.logaddexp(0, z) - y * z)).sum())
            e = part * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
            grad += np.bincount(col, np.repeat(e, count), BUCKETS)
            of_bias += e.sum()
        return total + ridge / 2 * float(x[:-1] @ x[:-1]), np.append(grad * value + ridge * x[:-1], of_bias)

    x = np.zeros(BUCKETS + 1)
    x[-1] = np.log(max(weight[labels == 1].sum(), 1e-9) / max(weight[labels == 0].sum(), 1e-9))
    now, grad = loss(x)
    end, steps = ENOUGH * np.linalg.norm(grad), []
    for _ in range(ROUNDS):
        if np.linalg.norm(grad) <= end:
            break
        d, back = -grad, []
        for s, g in reversed(steps):
            back.append((s @ d) / (s @ g))
            d -= back[-1] * g
        d *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / np.linalg.norm(grad)
        for (s, g), a in zip(steps, reversed(back), strict=True):
            d += s * (a - (g @ d) / (s @ g))
        length, slope = 1.0, float(grad @ d)
        while (then := loss(x + length * d))[0] > now + 1e-4 * length * slope and length > 1e-6:
            length /= 2
        if then[0] > now:
            break
        step, turn = length * d, then[1] - grad
        if step @ turn > 1e-12:
            steps = [*steps, (step, turn)][-MEMORY:]
        x, (now, grad) = x + step, then
    return x[:-1], float(x[-1])


def learn_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Train on the rows of ``docs`` (``doc_id``, ``text``) that ``labels``
    (``doc_id``, ``toxic``) marks 0 or 1; a document with several labels is
    toxic if one of them says so. Null ids, texts and labels teach nothing.

    Counts per bucket cover every labelled row (at most ``BUCKETS`` sums reach
    the driver). The regression is fitted on at most about ``fit_rows`` rows,
    taken by a hash of the id, half of them toxic where there are as many;
    each row weighs what it stands for. They are held packed by the driver,
    at most ``BUCKETS`` / 8 bytes each. Every bucket that the labelled rows
    hold is a feature; its ridge is divided by the square of its evidence, the
    standard deviations by which its toxic count is off what the clean share
    predicts. One class alone gives a model that
    always says so.
    """
    d = pick(docs, doc_id="doc_id:bigint", text="text:string").where("doc_id is not null and text is not null")
    marks = (
        pick(labels, doc_id="doc_id:bigint", toxic="toxic:int").where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("label"))
    )
    # the plan of the large sizes at every size
    known = write_table(d.join(marks.hint("merge"), "doc_id").select("text", "label", "doc_id"), "labelled")
    sums = known.mapInArrow(_count, "bucket bigint, clean bigint, toxic bigint").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = sums.toPandas().to_numpy()
    n_docs = counts[counts[:, 0] == -1][:, 1:].sum(0)
    clean, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at, c, t in counts[counts[:, 0] >= 0]:
        clean[at], toxic[at] = c, t
    if not len(n_docs) or n_docs.min() == 0:
        return ToxicityModel(np.zeros(BUCKETS, np.float32), 20.0 if len(n_docs) and n_docs[1] else -20.0)
    ratios = log_count_ratios(clean, toxic)
    expected = (clean + toxic) * n_docs[1] / n_docs.sum()
    evidence = np.abs(toxic - expected) / np.sqrt(expected + 1)
    part = [min(1.0, fit_rows / 2 / n) for n in n_docs]
    pick_row = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(pick_row < F.when(F.col("label") == 1, part[1]).otherwise(part[0]))
    got = sample.select("doc_id", "label", "text").mapInArrow(_features, "doc_id bigint, label int, buckets binary").toArrow()
    rows = sorted(zip(got["doc_id"].to_pylist(), got["label"].to_pylist(), got["buckets"].to_pylist(), strict=True))
    del got
    y = np.array([r[1] for r in rows], float)
    # a ridge divided by a square is a value times its root
    value = ratios * evidence
    w, b = fit_logistic([r[2] for r in rows], y, np.where(y == 1, 1 / part[1], 1 / part[0]), value)
    return ToxicityModel((w * value).astype(np.float32), b)


def _score(model: ToxicityModel):
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = np.array([weights[_distinct(t.as_py() or "")].sum(dtype=np.float64) for t in b.column(1)]) + bias
            score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) for
    every row of ``docs`` (``doc_id``, ``text``), whole texts.

    Defined cases: a null or empty text scores by the bias alone; repeated
    ids are scored row by row; a null id stays null; an empty table gives no
    rows; other columns are ignored."""
    d = pick(docs, doc_id="doc_id:bigint", text="text:string")
    return d.mapInArrow(_score(model), "doc_id bigint, score double, predicted int")


def classify_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Train on the labelled documents whose crc32(doc_id) modulo ``modulus`` is
    not ``held_out``, score all; ``held_out`` marks the others (false
    without an id)."""
    d = pick(docs, doc_id="doc_id:bigint", text="text:string")
    model = learn_toxicity(d.where(id_remainder("doc_id", modulus) != held_out), labels)
    is_held = F.coalesce(id_remainder("doc_id", modulus) == held_out, F.lit(False))
    return score_toxicity(d, model).select("doc_id", is_held.alias("held_out"), "score", "predicted")
