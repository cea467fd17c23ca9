"""Line dedup (7): drop lines that many documents share.

Every document's distinct normalised lines are exploded to 128-bit hashes,
the distinct documents of each hash are counted, and lines whose hash is
over the threshold are dropped from every document but one. What is left is
joined again in its old order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import pick, text_bytes, tidy, write_table

MIN_CHARS = 20
MIN_DOCS = 3
STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line without outer white space, A-Z lowered; None if it has fewer
    than ``min_chars`` code points."""
    key = line.strip(STRIP).lower()
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


@tidy
def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, digests = [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                seen = set()
                for line in text.as_py().split(b"\n"):
                    key = line_key(line, min_chars)
                    if key is not None:
                        seen.add(xxhash.xxh3_128_digest(key))
                ids += [doc_id] * len(seen)
                digests += seen
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.binary())], ["doc_id", "line_hash"])

    return run


@tidy
def _rebuild(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(b.column(1), b.column(2), strict=True):
                lines = text.as_py().split(b"\n")
                gone = set(drop.as_py() or ())
                kept = lines
                if gone:
                    kept = [x for x in lines if (k := line_key(x, min_chars)) is None or xxhash.xxh3_128_digest(k) not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), *b.columns[3:]],
                names=["doc_id", "text", "n_lines", "n_dropped", *b.schema.names[3:]],
            )

    return run


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keep: tuple[str, ...] = ()) -> DataFrame:
    r"""``doc_id``, the kept ``text``, ``n_lines`` (before) and ``n_dropped``
    for every row of ``docs`` (``doc_id``, ``text``), and its columns named in
    ``keep`` as they are.

    A line's key is the line without outer ``[\x20\x09-\x0D]``, A-Z lowered.
    Keys of at least ``min_chars`` code points held by at least ``min_docs``
    distinct documents lose all their lines, except in the largest doc_id
    that holds them.

    Defined cases: a null or empty text is one empty line; a document
    without an id is not counted and keeps its lines; rows that repeat an id
    count as one document and are all returned; an empty table gives none.
    Other columns of ``docs`` are ignored; a kept column may have any name
    that the result does not.

    Only (hash, id) rows are shuffled for the counting: documents are
    counted per (hash, id) first, so a line in a third of all documents is
    summed before it meets in one task. The texts move once, with each
    document's own list of dropped hashes.
    """
    d = pick(docs, doc_id="doc_id:bigint", text="text:string").withColumn("text", text_bytes("text"))
    keys = write_table(
        d.where("doc_id is not null").mapInArrow(_keys(min_chars), "doc_id bigint, line_hash binary"), "line-keys"
    )
    # written, so that the join below is one between two plain shuffles, whose
    # skewed keys Spark splits
    shared = write_table(
        keys.groupBy("line_hash")
        .agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("line_hash", "keeper"),
        "shared-lines",
    )
    # a name that no kept column has
    gone = max(["drop", *keep], key=len) + "_"
    drops = (
        keys.join(shared.hint("merge"), "line_hash")
        .where("doc_id < keeper")
        .groupBy("doc_id")
        .agg(F.collect_set("line_hash").alias(gone))
    )
    whole = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_bytes(docs["text"].cast("string")).alias("text"), *(docs[c] for c in keep))
    kept = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return (
        whole.join(drops.hint("merge"), "doc_id", "left")
        .select("doc_id", "text", gone, *keep)
        .mapInArrow(_rebuild(min_chars), "doc_id bigint, text string, n_lines bigint, n_dropped bigint" + kept)
    )
