"""LM scoring (2): context-tree weighting over bytes.

Each byte is coded as eight binary decisions, most significant bit first.
Each decision (the bits already coded) has a context tree of its own: a node
at depth d stands for the d bytes before, and its children for one more. A
node has the Krichevsky-Trofimov estimate of its bits, and the weighted
probability Pw = 1/2 KT + 1/2 (product of its children's Pw), at the last
depth Pw = KT. A bit of a text is then predicted by mixing the estimates of
all depths on its path, each with its posterior weight; a context that the
training texts never reached predicts as its parent does. The trees are
those of the training texts and stay fixed, so a byte's probability depends
on the ``depth`` bytes before it and itself only: its gram.

Spark counts the grams, the trees are worked out over the sorted grams, and
every chunk of documents gets the probabilities of just its own grams back.
A text is read as ``depth`` bytes 0xFF, its UTF-8 bytes, and one more 0xFF
as its end; no text holds that byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geonest.llm.common import binary_list, give_back, handing_over, id_remainder, pick, release_shuffles, size_of, text_bytes, write_table

DEPTH = 5
#: Text bytes of one chunk, the unit that gets its probabilities back.
CHUNK_BYTES = 40 << 20
#: Text bytes of one piece of a chunk, and its documents at most.
PIECE_BYTES = 2 << 20
DOC_BITS = 14
DOCS = 1 << DOC_BITS
#: Bytes whose grams are sorted at once.
SLICE = 1 << 20
#: Distinct grams of a chunk that a worker holds before it asks for them.
HELD = 1 << 22
#: How pieces are written: a page is cut by its size from the first row on. Snappy would keep buffers
#: of the longest page outside the heap in every executor.
PAGES = {"compression": "zstd", "parquet.page.size.row.check.min": "1"}
#: Bytes of texts that Spark hands to a worker at once.
BATCH_BYTES = 4 << 20
#: Grams whose trees are worked out at once, at least; twice as many at most, but for a three-byte context.
BATCH = 1 << 18
PAD = 0xFF
HALF = np.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series above 8, reached by the recurrence."""
    x = np.asarray(x, np.float64)
    y, shift = x + 8, np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    r = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / y - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the KT block probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def grams(text: bytes, depth: int = DEPTH) -> np.ndarray:
    """Key of each byte and of the end: the bytes before it, the latest on top, then itself."""
    a = np.frombuffer(bytes([PAD]) * depth + text + bytes([PAD]), np.uint8)
    return _keys(a, depth)


def _keys(a: np.ndarray, depth: int) -> np.ndarray:
    m = max(0, len(a) - depth)
    # eight bytes from each place on; the context's last byte goes on top, the coded one out
    keys = np.ndarray((m,), "<u8", np.concatenate([a, np.zeros(8, np.uint8)]), 0, (1,)) << np.uint64(8)
    keys &= np.uint64((1 << 8 * (depth + 1)) - 1)
    keys |= a[depth:]
    return keys.view(np.int64)


class Level:
    """Distinct (context of d bytes, byte) rows with their counts."""

    def __init__(self, ids: np.ndarray, n: np.ndarray):
        self.ids, self.n = ids, n

    def shorter(self) -> tuple["Level", np.ndarray]:
        """The level of one byte of context less, and each row's row there."""
        ids, up = np.unique((self.ids >> 16 << 8) | (self.ids & 255), return_inverse=True)
        return Level(ids, np.bincount(up, self.n, len(ids))), up

    def nodes(self, k: int) -> "Nodes":
        return Nodes(self, k)


class Nodes:
    """The tree nodes of a level for the decision on bit ``k``."""

    def __init__(self, level: Level, k: int):
        top = level.ids >> (8 - k)
        self.head = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]])) if len(top) else np.zeros(0, np.int64)
        self.of = np.cumsum(np.isin(np.arange(len(top)), self.head, assume_unique=True)) - 1
        bit = (level.ids >> (7 - k)) & 1
        n1 = np.bincount(self.of, level.n * bit, len(self.head))
        n = np.bincount(self.of, level.n, len(self.head))
        self.kt = log_kt(n - n1, n1)
        self.seen = (n > 0)[self.of]
        n, n1 = n[self.of], n1[self.of]
        self.guess = (np.where(bit == 1, n1, n - n1) + 0.5) / (n + 1.0)
        self.pw, self.stop = self.kt, np.ones(len(self.kt))

    def weigh(self, children: np.ndarray) -> None:
        """Pw, and the posterior weight of stopping here, from the children's log Pw."""
        self.pw = np.logaddexp(HALF + self.kt, HALF + children)
        self.stop = np.exp(HALF + self.kt - self.pw)


def _climb(levels: list[Level], ups: list[np.ndarray], k: int, given: np.ndarray | None = None) -> list[Nodes]:
    """Nodes of bit k from the deepest level (first) up. ``given``: log Pw
    sums of the children of the deepest level, unless that is the last depth."""
    out = [levels[0].nodes(k)]
    if given is not None:
        out[0].weigh(given)
    for level, up in zip(levels[1:], ups, strict=True):
        below, here = out[-1], level.nodes(k)
        here.weigh(np.bincount(here.of[up[below.head]], below.pw, len(here.head)))
        out.append(here)
    return out


class Mix:
    """A bit's probability so far, the weight that is left, and the last estimate."""

    def __init__(self, p: np.ndarray, left: np.ndarray, last: np.ndarray):
        self.p, self.left, self.last = p, left, last

    def take(self, rows: np.ndarray) -> "Mix":
        return Mix(self.p[rows], self.left[rows], self.last[rows])

    def step(self, nodes: Nodes) -> "Mix":
        stop = nodes.stop[nodes.of]
        p = self.p + self.left * np.where(nodes.seen, stop * nodes.guess, self.last)
        return Mix(p, self.left * np.where(nodes.seen, 1 - stop, 0.0), np.where(nodes.seen, nodes.guess, self.last))


def _descend(nodes: list[Nodes], ups: list[np.ndarray], mix: Mix) -> Mix:
    """Mix from the shortest context (last in ``nodes``) down to the first."""
    mix = mix.step(nodes[-1])
    for at in range(len(nodes) - 2, -1, -1):
        mix = mix.take(ups[at]).step(nodes[at])
    return mix


def _ladder(keys: np.ndarray, n: np.ndarray, steps: int) -> tuple[list[Level], list[np.ndarray]]:
    levels, ups = [Level(keys, n)], []
    for _ in range(steps):
        level, up = levels[-1].shorter()
        levels.append(level)
        ups.append(up)
    return levels, ups


def _sorted_batches(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Sorted (keys, counts) of whole two-byte contexts, in one part; if they
    are many, in parts of whole three-byte contexts."""
    held, rows, most = [], 0, BATCH
    for b in batches:
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        rows += b.num_rows
        if rows >= most:
            keys, counts = (np.concatenate(c) for c in zip(*held, strict=True))
            part = keys >> (8 * (depth - 1))
            cut = int(np.searchsorted(part, part[-1]))
            del part
            if cut:
                yield _parts(keys[:cut], counts[:cut], depth)
            held, rows = [(keys[cut:].copy(), counts[cut:].copy())], len(keys) - cut
            most = max(BATCH, 2 * rows)  # a long context is not put together again for every batch
    if rows:
        yield _parts(*(np.concatenate(c) for c in zip(*held, strict=True)), depth)


def _parts(keys: np.ndarray, counts: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    if len(keys) < 2 * BATCH or depth < 3:
        return [(keys, counts)]
    heads = np.append(_runs(keys >> (8 * (depth - 2))), len(keys))
    cuts = np.unique(heads[np.searchsorted(heads, np.append(np.arange(0, len(keys), BATCH), len(keys)))])
    return [(keys[lo:hi], counts[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _joined(parts: list[tuple[np.ndarray, np.ndarray]], depth: int) -> tuple[Level, list[Nodes]]:
    """The level of two-byte contexts over several parts, and its nodes by bit;
    one part's deeper levels are held at a time."""
    found, nodes_of, sums_of = [], [[] for _ in range(8)], [[] for _ in range(8)]
    for keys, n in parts:
        levels, ups = _ladder(keys, n, depth - 3)
        two, up = levels[-1].shorter()
        found.append(two)
        for k in range(8):
            below, here = _climb(levels, ups, k)[-1], two.nodes(k)
            nodes_of[k].append(two.ids[here.head] >> (8 - k))
            sums_of[k].append(np.bincount(here.of[up[below.head]], below.pw, len(here.head)))
    ids, at = np.unique(np.concatenate([x.ids for x in found]), return_inverse=True)
    two = Level(ids, np.bincount(at, np.concatenate([x.n for x in found]), len(ids)))
    out = [two.nodes(k) for k in range(8)]
    for k, nodes in enumerate(out):
        at = np.searchsorted(two.ids[nodes.head] >> (8 - k), np.concatenate(nodes_of[k]))
        nodes.weigh(np.bincount(at, np.concatenate(sums_of[k]), len(nodes.head)))
    return two, out


def _summaries(depth: int):
    """Counts by (previous byte, byte) and, for each node there, its children's log Pw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _sorted_batches(batches, depth):
            if len(parts) > 1:
                two, nodes = _joined(parts, depth)
                below_of = nodes.__getitem__
            else:
                levels, ups = _ladder(*parts[0], depth - 2)
                two = levels[-1]
                below_of = lambda k: _climb(levels, ups, k)[-1]  # noqa: B023, E731
            one, up = two.shorter()
            out_key, out_bit, out_value = [one.ids], [np.full(len(one.ids), -1)], [one.n]
            for k in range(8):
                below, here = below_of(k), one.nodes(k)
                sums = np.bincount(here.of[up[below.head]], below.pw, len(here.head))
                out_key.append(one.ids[here.head] >> (8 - k) << (8 - k))
                out_bit.append(np.full(len(sums), k))
                out_value.append(sums)
            cols = (np.concatenate(x) for x in (out_key, out_bit, out_value))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.float64()), strict=True)], ["key", "bit", "value"])

    return run


def _top(rows: list[tuple[int, int, float]]) -> tuple[np.ndarray, list[Mix]]:
    """Depths 0 and 1: the (previous byte, byte) keys, at most 65,536, and the
    mix that each of their bits has after depth 1."""
    table = np.array(sorted(rows), np.float64).reshape(-1, 3)
    counts = table[table[:, 1] == -1]
    one = Level(counts[:, 0].astype(np.int64), counts[:, 2])
    zero, up = one.shorter()
    mixes = []
    for k in range(8):
        part = table[table[:, 1] == k]
        nodes = _climb([one, zero], [up], k, part[:, 2])
        m = len(zero.ids)
        mixes.append(_descend(nodes, [up], Mix(np.zeros(m), np.ones(m), np.full(m, 0.5))))
    return one.ids, mixes


def _gram_scores(depth: int, ids: np.ndarray, top: list[Mix]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _sorted_batches(batches, depth):
            many = len(parts) > 1
            if many:
                two, nodes = _joined(parts, depth)
            else:
                levels, ups = _ladder(*parts[0], depth - 2)
                two = levels[-1]
            at = np.searchsorted(ids, (two.ids >> 16 << 8) | (two.ids & 255))
            begun = [top[k].take(at).step(nodes[k]) if many else top[k].take(at) for k in range(8)]
            for keys, n in parts:
                if many:
                    levels, ups = _ladder(keys, n, depth - 3)
                    part, up = levels[-1].shorter()
                    place = np.searchsorted(two.ids, part.ids)[up]
                score = np.zeros(len(keys))
                for k in range(8):
                    mix = begun[k].take(place) if many else begun[k]
                    score += np.log10(_descend(_climb(levels, ups, k), ups, mix).p)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(score)], ["gram", "value"])
        parts = keys = n = levels = ups = two = nodes = at = begun = part = up = place = mix = score = None
        give_back()

    return run


def gram_scores(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``gram``, ``value`` (log10 probability of its last byte after the others)
    for every row of ``counts`` (``gram`` once each, ``n`` in training, which
    may be 0). Read twice: pass a written table.

    The grams are dealt by the two bytes before the coded one and sorted, so
    the contexts of each depth lie together. Depths 0 and 1 are worked out
    apart, from at most 65,536 sums."""
    spark = counts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.select("gram", "n").repartition(n, F.shiftright("gram", 8 * (depth - 1))).sortWithinPartitions("gram")
    sums = dealt.mapInArrow(_summaries(depth), "key bigint, bit int, value double").groupBy("key", "bit").agg(F.sum("value").alias("value"))
    ids, top = _top([tuple(r) for r in sums.collect()])
    release_shuffles(spark)
    return dealt.mapInArrow(_gram_scores(depth, ids, top), "gram bigint, value double")


def padded(text: Column, depth: int = DEPTH) -> Column:
    """A text as chunks hold it: ``depth`` bytes PAD, its bytes, and one PAD as its end."""
    return F.concat(F.lit(bytes([PAD]) * depth), text, F.lit(bytes([PAD])))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each text begins."""
    begin = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[begin[0]:begin[-1]], begin[:-1] - begin[0]


def _slices(texts: pa.Array, depth: int, span: tuple[int, int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, document numbers) of padded texts, SLICE bytes of them at once; with ``span``, the keys from one to below the other."""
    a, begin = _bytes_of(texts)
    for first in range(depth, len(a), SLICE):
        end = min(first + SLICE, len(a))
        keys = _keys(a[first - depth:end], depth)
        use = np.ones(len(keys), bool) if span is None else (keys >= span[0]) & (keys < span[1])
        # the bytes that a text begins with are not coded
        starts = begin[np.searchsorted(begin, first - depth, "right"):np.searchsorted(begin, end)]
        pads = (starts[:, None] + np.arange(depth)).ravel() - first
        use[pads[(pads >= 0) & (pads < len(use))]] = False
        lo, hi = np.searchsorted(begin, first, "right"), np.searchsorted(begin, end)
        doc = np.repeat(np.arange(lo - 1, hi, dtype=np.int32), np.diff(np.concatenate([[first], begin[lo:hi], [end]])))
        keys, doc = keys[use], doc[use]
        yield keys, doc


def _coded_words(texts: pa.Array, depth: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of padded texts, the place of each word of all texts
    among them, and where each text's words begin (and the last one's end)."""
    plain = pc.binary_slice(texts, depth, -1).view(pa.string())  # nothing below minds bytes that are no UTF-8
    split = pc.ascii_split_whitespace(pc.ascii_lower(plain))
    found = split.flatten().view(pa.binary())
    # white space at an end leaves an empty word there
    some = pc.not_equal(pc.binary_length(found), 0).to_numpy(zero_copy_only=False)
    coded = found.filter(pa.array(some)).dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(some)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    return coded.dictionary, coded.indices.to_numpy(), ends


def _words(texts: pa.Array, depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``_coded_words`` with the words as Python has them."""
    names, at, ends = _coded_words(texts, depth)
    return binary_list(names), at, ends


def _numbered(names: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct words of a chunk, the empty one (the end of a text) first
    and the others as they come in its pieces, and the numbers of each piece's words."""
    cuts = np.cumsum([1, *map(len, names)])
    found = pa.concat_arrays([pa.array([b""], pa.binary()), *names])
    names.clear()  # what is put together need not be held beside it
    coded = found.dictionary_encode()
    del found
    return coded.dictionary, np.split(coded.indices.to_numpy(), cuts)[1:-1]


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


_DOC = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary())])


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The documents again, ``most`` bytes of them at once or just beyond."""
    held, size, rows = [], 0, 0
    for b in batches:
        before = np.concatenate([[0], np.cumsum(pc.binary_length(b.column(2)).to_numpy().astype(np.int64))])
        first = 0
        while first < b.num_rows:
            end = min(int(np.searchsorted(before, before[first] + most - size)), first + DOCS - rows, b.num_rows)
            held.append(b.slice(first, end - first))
            size, rows, first = size + int(before[end] - before[first]), rows + end - first, end
            if size >= most or rows >= DOCS:
                yield _one(held)
                held, size, rows = [], 0, 0
        b = None
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """A copy, which holds none of the batches it comes from."""
    return pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(c) for b in held]) for c in range(len(_DOC))], schema=_DOC)


def _bundle(chunk_bytes: int, depth: int):
    """Puts a task's documents (padded texts) into chunks, which are written
    by pieces. A chunk asks for its distinct grams and words, each with its
    count in training texts; what only other texts have has count 0."""
    pads = depth + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        asks = _Asks(number)
        for part in _pieces(batches, min(PIECE_BYTES, chunk_bytes)):
            yield _row_batch(number, 1, place=[len(asks.names)], docs=[_stored(part)])
            yield from asks.add(part, depth)
            if len(asks.names) % 4 == 0:
                give_back()
            if asks.size - pads * asks.rows >= chunk_bytes:
                yield from asks.rest()
                number += 1
                asks = _Asks(number)
        part = None
        if asks.size:
            yield from asks.rest()
        asks = None
        give_back()

    return run


def _row_batch(chunk: int, rows: int, **cols) -> pa.RecordBatch:
    """Rows of the written table; columns not given are null."""
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(rows, chunk)), *(pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(rows, f.type) for f in _ROWS)],
        ["chunk", *(f.name for f in _ROWS)],
    )


_ROWS = pa.schema([("place", pa.int32()), ("docs", pa.binary()), ("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])


def _stored(part: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _DOC, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(part)
    return sink.getvalue().to_pybytes()


def _read(docs: pa.Buffer) -> pa.RecordBatch:
    return pa.ipc.open_stream(docs).read_next_batch()


class _Asks:
    """The grams and words of one chunk."""

    def __init__(self, chunk: int):
        self.chunk, self.rows, self.size, self.ends = chunk, 0, 0, 0
        self.held, self.new = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        self.names: list[pa.Array] = []
        self.counts: list[np.ndarray] = []

    def add(self, part: pa.RecordBatch, depth: int) -> Iterator[pa.RecordBatch]:
        trains = ~part.column(1).to_numpy(zero_copy_only=False)
        names, at, ends = _coded_words(part.column(2), depth)
        self.names.append(names)
        self.counts.append(np.bincount(at[np.repeat(trains, np.diff(ends))], minlength=len(names)))
        self.ends += int(trains.sum())
        self.rows += part.num_rows
        self.size += pc.sum(pc.binary_length(part.column(2))).as_py()
        for keys, n in _distinct_grams(part.column(2), trains.astype(np.int64), depth):
            self.held.append((keys, n))
            self.new += len(keys)
            if self.new > len(self.held[0][0]) // 2 + SLICE:
                yield from self._merge(HELD)

    def _merge(self, most: int) -> Iterator[pa.RecordBatch]:
        """One list of all; it is asked for if it is longer than ``most``."""
        self.held, self.new = [_merge(self.held)], 0
        keys, n = self.held[0]
        if len(keys) > most:
            for at in range(0, len(keys), BATCH):
                m = len(keys[at:at + BATCH])
                yield _row_batch(self.chunk, m, gram=keys[at:at + BATCH], n=n[at:at + BATCH])
            self.held = [(keys[:0].copy(), n[:0].copy())]

    def rest(self) -> Iterator[pa.RecordBatch]:
        yield from self._merge(0)
        self.held = []
        give_back()
        names, numbers = _numbered(self.names)
        n = np.zeros(len(names), np.int64)
        n[0] = self.ends
        for at, m in zip(numbers, self.counts, strict=True):
            n[at] += m
        for at in range(0, len(n), BATCH):
            m = len(n[at:at + BATCH])
            yield _row_batch(self.chunk, m, place=np.arange(at, at + m, dtype=np.int32), word=names[at:at + m], n=n[at:at + m])


def _merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One list of sorted lists, each without repeats."""
    keys = np.concatenate([k for k, _ in held])
    keys.sort()
    keys = keys[_runs(keys)] if len(keys) else keys
    n = np.zeros(len(keys), np.int64)
    while held:
        each, m = held.pop()
        n[np.searchsorted(keys, each)] += m
    return keys, n


def _distinct_grams(texts: pa.Array, trains: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct grams of some texts with their counts in the training ones, a slice at a time."""
    for keys, doc in _slices(texts, depth):
        if len(keys):
            keys <<= 1
            keys |= trains[doc]
            del doc
            keys.sort()
            head = _runs(keys >> 1)
            yield keys[head] >> 1, np.add.reduceat(keys & 1, head)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, is_word, item, value) rows as one row per chunk and kind with the
    items and values as bytes; what is held at once is bounded."""
    held, rows = [], 0
    for b in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
        rows += b.num_rows
        if rows >= 4 * BATCH:
            yield _packed(held)
            held, rows = [], 0
    if held:
        yield _packed(held)
    held = None
    give_back()


def _packed(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    chunk, is_word, item, value = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.lexsort((item, is_word, chunk))
    chunk, is_word, item, value = chunk[order], is_word[order], item[order].astype("<i8"), value[order].astype("<f8")
    head = np.flatnonzero(np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (is_word[1:] != is_word[:-1])]))
    cuts = list(zip(head, np.append(head[1:], len(chunk)), strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(chunk[head]), pa.array(is_word[head]),
            # lowest bytes of all items first, and so on: sorted items differ little in the others
            pa.array([item[a:b].view(np.uint8).reshape(-1, 8).T.tobytes() for a, b in cuts], pa.binary()),
            pa.array([value[a:b].tobytes() for a, b in cuts], pa.binary()),
        ],
        ["chunk", "is_word", "items", "values"],
    )


def _by_item(values: pa.Table, is_word: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sorted grams, or words' numbers, and their values."""
    rows = np.flatnonzero(values.column("is_word").to_numpy() == is_word).tolist()
    items = [np.frombuffer(values.column("items")[i].as_buffer(), np.uint8).reshape(8, -1) for i in rows]
    item = np.concatenate([np.zeros((8, 0), np.uint8), *items], axis=1).T.copy().view("<i8").ravel()
    order = np.argsort(item, kind="stable")
    value = np.concatenate([np.zeros(0), *(np.frombuffer(values.column("values")[i].as_buffer(), "<f8") for i in rows)])
    return item[order], value[order]


def _text_scores(texts: pa.Array, depth: int, keys: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """The sum of the values of each padded text's grams."""
    score = np.zeros(len(texts))
    for k, doc in _slices(texts, depth):
        if len(k):
            k <<= DOC_BITS
            k |= doc
            del doc
            k.sort()
            head = _runs(k >> DOC_BITS)
            own = log_p[np.searchsorted(keys, k[head] >> DOC_BITS)]
            each = np.repeat(own, np.diff(np.append(head, len(k))))
            k &= DOCS - 1
            score += np.bincount(k, each, len(score))
    return score


def _apply(depth: int, n_tokens: int, n_words: int):
    def run(chunk: pa.Table, values: pa.Table) -> pa.Table:
        keys, log_p = _by_item(values, False)
        _, count = _by_item(values, True)
        del values
        give_back()
        order = np.argsort(chunk.column("place").to_numpy())
        pieces = [chunk.column("docs")[i].as_buffer() for i in order.tolist()]
        out, names, places = [], [], []
        for docs in pieces:
            part = _read(docs)
            texts = part.column(2)
            score = _text_scores(texts, depth, keys, log_p)
            found, at, ends = _coded_words(texts, depth)
            names.append(found)
            places.append((at, ends))
            n_bytes = pc.binary_length(texts).to_numpy().astype(np.int64) - depth - 1
            out.append((_own(part.column(0)), _own(part.column(1)), score, n_bytes))
            del part, texts, score, found, at, ends
            if len(names) % 4 == 0:
                give_back()
        del chunk, pieces, docs, keys, log_p
        give_back()
        base = np.log10((count + 0.1) / (n_tokens + 0.1 * (n_words + 1)))
        tables = []
        _, numbers = _numbered(names)
        for (doc_id, is_held, score, n_bytes), (at, ends), number in zip(out, places, numbers, strict=True):
            words = np.diff(ends)
            doc, at = np.repeat(np.arange(len(words)), words), number[at]
            tables.append(
                pa.table(
                    {
                        "doc_id": doc_id,
                        "held_out": is_held,
                        "n_tokens": words + 1,
                        # word 0 is the end, the last token of each text
                        "n_known": np.bincount(doc, count[at] > 0, len(words)).astype(np.int64) + int(count[0] > 0),
                        "train_tokens": np.full(len(words), n_tokens, np.int64),
                        "base_score": np.bincount(doc, base[at], len(words)) + base[0],
                        "score": score,
                        "n_bytes": n_bytes,
                        "bits_per_byte": -score * np.log2(10) / (n_bytes + 1),
                    }
                )
            )
        del out, places, numbers, number, at, doc
        give_back()
        return pa.concat_tables(tables)

    return run


def _own(column: pa.Array) -> pa.Array:
    """A copy, which does not hold the batch it comes from."""
    return column.take(pa.array(np.arange(len(column))))


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint, bits_per_byte double"


def score_documents(docs: DataFrame, modulus: int = 10, held_out: int = 0, depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Score every row of ``docs`` (``doc_id``, ``text``), learning from those
    whose crc32(doc_id) modulo ``modulus`` is not ``held_out``.

    ``score`` is the log10 probability of the text and its end under the
    trees, ``bits_per_byte`` its code length per byte (the end counts as
    one), ``base_score`` the log10 probability of its words and end under
    word counts (tenth-smoothed). ``n_known`` counts tokens seen in
    training, of which there are ``train_tokens``.

    Defined cases: a null or empty text is its end alone; a row without an
    id is not held out and teaches; repeated ids are counted and scored row
    by row; an empty table gives no rows; other columns are ignored.

    Each task puts its documents into chunks of about ``chunk_bytes``, which
    are written in pieces of ``PIECE_BYTES``. A chunk asks for each distinct
    gram and word once and gets them back with their values; so a frequent
    gram or word is a row per chunk, and no table of all grams has to fit
    anywhere. A worker holds a piece's grams and a chunk's distinct ones; of
    these it asks for ``HELD`` at a time, and then for some again.
    """
    if not 2 <= depth <= 5:
        raise ValueError("depth must be from 2 to 5: a gram and a document's number share 63 bits")
    d = pick(docs, doc_id="doc_id:bigint", text="text:string")
    _, size = size_of(d)
    is_held = F.coalesce(id_remainder("doc_id", modulus) == held_out, F.lit(False))
    n_tasks = max(1, -(-size // chunk_bytes))
    whole = d.select("doc_id", is_held.alias("held_out"), padded(text_bytes("text"), depth).alias("text")).coalesce(n_tasks)
    with handing_over(docs.sparkSession, BATCH_BYTES):
        asked = write_table(whole.mapInArrow(_bundle(chunk_bytes, depth), "chunk bigint, place int, docs binary, gram bigint, word binary, n bigint"), "lm-asked", PAGES)
    chunks = asked.where("docs is not null").select("chunk", "place", "docs")
    asked_grams = asked.where("gram is not null").select("chunk", "gram", "n")
    counts = write_table(asked_grams.groupBy("gram").agg(F.sum("n").alias("n")), "lm-grams")
    release_shuffles(docs.sparkSession)
    by_word = Window.partitionBy("word")
    word_counts = write_table(
        asked.where("word is not null").select(
            "chunk", "place", F.sum("n").over(by_word).cast("double").alias("value"),
            (F.min("chunk").over(by_word) == F.col("chunk")).alias("first"),
        ),
        "lm-words",
    )
    release_shuffles(docs.sparkSession)
    # a word is counted in the first chunk that asked for it
    total = word_counts.where("first").agg(F.sum("value").alias("n"), F.count_if(F.col("value") > 0).alias("v")).first()
    values = (
        asked_grams.join(gram_scores(counts, depth), "gram")
        .select("chunk", F.lit(False).alias("is_word"), F.col("gram").alias("item"), "value")
        .union(word_counts.select("chunk", F.lit(True).alias("is_word"), F.col("place").cast("long").alias("item"), "value"))
        .mapInArrow(_pack, "chunk bigint, is_word boolean, items binary, values binary")
    )
    scored = (
        chunks.groupBy("chunk")
        .cogroup(values.groupBy("chunk"))
        .applyInArrow(_apply(depth, int(total["n"] or 0), int(total["v"] or 0)), SCORES)
    )
    with handing_over(docs.sparkSession, BATCH_BYTES):
        return write_table(scored, "lm-scores")
