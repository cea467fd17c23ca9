"""Best-fit packing (10): token pieces into sequences of a fixed length.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
The sizes are then packed by one sequential best-fit-decreasing pass on the
driver, instead of bulk-synchronous sweeps on Spark: as a size is an integer
up to ``capacity``, documents and gaps of one size are one run (size, count),
so the pass needs one count per size however many documents there are. Each
document gets the next larger gap (its successor); documents that want the
same gap are told apart by their rank within their size, which also names the
very sequence each one gets.

Ranks and places are computed by Spark for all pieces: salted ranks by size,
then a lookup of each (size, rank) in the match intervals.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geonest.llm.common import binary_list, pick, text_bytes, tidy, worker_state, write_table

CAPACITY = 2048
SEPARATOR = 0
#: Encoded words that a Python worker keeps (bounded memory, about 150 bytes each).
WORD_CACHE = 400_000
#: Text bytes, at least, whose distinct words are looked up at once; a longer text is looked up alone.
TEXT_BYTES = 4 << 20
#: Words that the tokenizer library gets at once: it holds some hundreds of bytes for each of their tokens.
CALL_WORDS = 8192
#: How pieces are written: Snappy keeps buffers of a page's size outside the heap of every executor.
PAGES = {"compression": "zstd"}
#: Rows that one salted rank group holds on average.
RANK_ROWS = 500_000

WORD_END = "</w>"
#: Letters below this (Latin) are letters to the vocabulary too, stay as they
#: are under its NFC, and have the small letters that Python knows.
LAST_PLAIN = "\u0250"
#: But for this one, whose small letter is two characters.
DOTTED = "\u0130"
TAIL = b"!#$%&()*+,-./:;<=>?@[]^_{|}~\\\""


class WordEncoder:
    """Ids of whole texts, one white-space delimited word at a time.

    The vocabulary drops white space and never merges across it, so a text's
    ids are its words' ids one after another; each distinct word (ASCII
    lower-cased, as the vocabulary is) of a group of texts is looked up once.
    The words met last are kept: when half of the places are taken, those
    met since the last time stay and older ones go. Words that end in ASCII
    punctuation reuse the ids of the bare word. A text with ``<|`` may hold
    a special token, whose case counts: it is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        # the same merges for words of plain letters: nothing to normalise, and no pattern to match
        self.letters = Tokenizer(self.tok.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.tok.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters only are encoded as one text, ``CALL_WORDS`` at a
        time: each is one unit of the vocabulary, whose last id, alone, ends a
        word. Others go one by one."""
        out: dict[bytes, bytes] = {}
        plain, other = [], []
        for w in words:
            text = w.decode("utf-8", "replace")
            (plain if _plain(text) else other).append((w, text))
        for at in range(0, len(plain), CALL_WORDS):
            part = plain[at:at + CALL_WORDS]
            joined = " ".join([t for _, t in part]).lower()
            ids = np.array(self.letters.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) == len(part):
                lo, data = 0, ids.tobytes()
                for (w, _), hi in zip(part, cuts, strict=True):
                    out[w] = data[4 * lo:4 * hi]
                    lo = hi
            else:
                other += part
        for at in range(0, len(other), CALL_WORDS):
            part = other[at:at + CALL_WORDS]
            got = self.tok.encode_batch_fast([t for _, t in part], add_special_tokens=False)
            for (w, _), e in zip(part, got, strict=True):
                out[w] = np.array(e.ids, "<u4").tobytes()
        return out

    def ids(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each word."""
        out = dict(zip(words, map(self.cache.get, words), strict=True))
        found: dict[bytes, bytes] = {}
        new, built = set(), []
        for w in [w for w, ids in out.items() if ids is None]:
            ids = self.older.get(w)
            if ids is not None:
                found[w] = ids
                continue
            bare = w.rstrip(TAIL)
            if bare and len(bare) < len(w) and (bare[-1:].isalnum() or _plain(bare.decode("utf-8", "replace"))):
                built.append((w, bare, w[len(bare):]))
            else:
                new.add(w)
        for x in {x for _, bare, tail in built for x in (bare, tail)} - new - found.keys():
            ids = self.cache.get(x, self.older.get(x))
            if ids is None:
                new.add(x)
            else:
                found[x] = ids
        if new:
            found.update(self._encode(list(new)))
        for w, bare, tail in built:
            found[w] = found[bare] + found[tail]
        out.update(found)
        if len(self.cache) + len(found) > WORD_CACHE // 2:
            self.older, self.cache = self.cache, {}
        if len(found) <= WORD_CACHE // 2:
            self.cache.update(found)
        return out

    def texts(self, texts: list[bytes] | pa.Array) -> Iterator[bytes]:
        """Little-endian uint32 ids of each text."""
        texts = pa.array(texts, pa.binary()) if isinstance(texts, list) else texts
        at = 0
        for end in _groups(texts):
            yield from self._group(texts.slice(at, end - at))
            at = end

    def _group(self, texts: pa.Array) -> Iterator[bytes]:
        texts = texts.cast(pa.large_binary()).view(pa.large_string())  # nothing below minds bytes that are no UTF-8
        special = pc.match_substring(texts, "<|")
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(special, pa.scalar("", pa.large_string()), texts)))
        words = split.flatten().view(pa.large_binary()).dictionary_encode()
        names = binary_list(words.dictionary)
        ids = self.ids(names)
        joined = pa.array([ids[w] for w in names], pa.large_binary()).take(words.indices)
        ends = np.frombuffer(joined.buffers()[1], "<i8")[: len(joined) + 1]
        ends = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        data = joined.buffers()[2] or b""
        for whole, t, lo, hi in zip(special.to_pylist(), texts, ends.tolist(), ends[1:].tolist(), strict=False):
            if whole:
                e = self.tok.encode_batch_fast([t.as_buffer().to_pybytes().decode("utf-8", "replace")], add_special_tokens=False)[0]
                yield np.array(e.ids, "<u4").tobytes()
            else:
                yield bytes(data[lo:hi])


def _plain(text: str) -> bool:
    return text.isalpha() and (text.isascii() or (max(text) < LAST_PLAIN and DOTTED not in text))


def _groups(texts: pa.Array) -> Iterator[int]:
    """Where each group of texts ends."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    at = 0
    while at < len(sizes):
        at = min(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TEXT_BYTES)) + 1, len(sizes))
        yield at


def _encoder(path: str) -> WordEncoder:
    return worker_state(__name__, path, lambda: WordEncoder(path))


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@tidy
def _pieces(path: str, capacity: int, separator: int, with_ids: bool):
    end_ids = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path)
        for whole in batches:
            at = 0
            for end in _groups(whole.column(1)):
                b, at = whole.slice(at, end - at), end
                rows: list[tuple] = []
                for doc_id, ids in zip(b.column(0).to_pylist(), enc.texts(b.column(1)), strict=True):
                    ids += end_ids
                    for piece, lo in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[lo:lo + 4 * capacity]
                        rows.append((doc_id, piece, lo // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=False)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(kinds)],
                )

    return run


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document's ids followed by ``separator``;
    only documents longer than ``capacity`` are cut. ``with_ids`` adds the
    ids as little-endian uint32 bytes. ``vocabulary`` is the path of a
    word-level tokenizer file that every executor can read."""
    d = pick(docs, doc_id="doc_id:bigint", text="text:string").withColumn("text", text_bytes("text"))
    return d.mapInArrow(_pieces(vocabulary, capacity, separator, with_ids), PIECES + ", ids binary" * with_ids)


def match_rounds(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int]], int]:
    """Best-fit matches of ``counts`` (pieces by size) and the number of sequences.

    A match (size, first rank, first sequence, offset) holds for the ranks
    from there to the next match of that size: rank r goes to sequence
    ``first sequence + r - first rank``. Sizes are swept from the largest
    down. In each round, documents of the size take the smallest gaps that
    fit, one document a gap, by rank; the gaps shrink and compete again in
    the next round; when no gap fits, the rest open sequences of their own.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: its sequences as (first, count)
    sizes: list[int] = []  # the gaps in use, sorted
    matches: list[tuple[int, int, int, int]] = []
    n_seq = 0

    def add(gap: int, first: int, count: int) -> None:
        if gap <= 0:
            return
        if not runs[gap]:
            insort(sizes, gap)
        runs[gap].append((first, count))

    for size in sorted((s for s, n in counts.items() if n > 0), reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect_left(sizes, size)
            if at == len(sizes):  # no gap fits: as many new sequences as these documents need
                opened = -(-left // (capacity // size))
                add(capacity, n_seq, opened)
                n_seq += opened
                continue
            gap = sizes[at]
            first, count = runs[gap].pop()
            n = min(left, count)
            matches.append((size, rank, first, capacity - gap))
            if n < count:
                runs[gap].append((first + n, count - n))
            if not runs[gap]:
                sizes.pop(at)
            add(gap - size, first, n)
            rank, left = rank + n, left - n
    return matches, n_seq


def _place(matches: list[tuple[int, int, int, int]]):
    table = np.array(sorted(matches), np.int64).reshape(-1, 4)
    keys, first_rank, first_seq, offset = (table[:, 0] << 40) + table[:, 1], table[:, 1], table[:, 2], table[:, 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "size_rank"))
            at = np.searchsorted(keys, (length << 40) + rank, "right") - 1
            b = b.drop_columns(["size_rank"])
            yield b.append_column("sequence_id", pa.array(first_seq[at] + rank - first_rank[at])).append_column("offset", pa.array(offset[at]))

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (``doc_id``, ``piece``, ``length`` of 1 to ``capacity``, and
    any further columns but ``salt``, ``before``, ``size_rank``) with
    ``sequence_id`` and ``offset``: places without overlap or gap from 0 on,
    in best-fit order. Read several times: pass a written table.

    A piece's rank within its size is its place within a salted part of the
    size plus the counts of the parts before, so a size that a third of all
    pieces share is not sorted in one task. The driver only sees the count
    of each size, at most ``capacity`` rows.
    """
    n = pieces.count()
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(int(n**0.5) + 1)))
    parts = salted.groupBy("length", "salt").count()
    counts = {int(r["length"]): int(r["n"]) for r in parts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    if any(not 0 < size <= capacity for size in counts):
        raise ValueError(f"piece lengths must be from 1 to {capacity}")
    by_size = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("length", "salt", F.coalesce(F.sum("count").over(by_size), F.lit(0)).alias("before"))
    in_part = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("in_part", F.row_number().over(in_part) - 1)
        .join(before, ["length", "salt"])
        .withColumn("size_rank", F.col("before") + F.col("in_part"))
        .select(*pieces.columns, "size_rank")
    )
    matches, _ = match_rounds(counts, capacity)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_place(matches), schema + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR, with_ids: bool = False) -> DataFrame:
    """Token pieces of all documents packed into sequences of ``capacity``.

    ``docs``: ``doc_id``, ``text``. One row per piece: ``doc_id``, ``piece``,
    ``start`` (its document's ids before it), ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``, and ``ids`` if asked for.

    Defined cases: a null or empty text is just the separator; rows that
    repeat an id, or have none, are packed like all others; ties of size go
    by id, piece and content; an empty table gives no rows; other columns
    are ignored.
    """
    return pack_pieces(write_table(token_pieces(docs, vocabulary, capacity, separator, with_ids), "pieces", PAGES), capacity)
