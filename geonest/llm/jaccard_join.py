"""N-gram Jaccard join (6) by PartEnum signatures.

Sets of word shingles are put into bands by size, so that similar sets fall
into the same or neighbouring bands. For a band, similarity bounds the
number k of features that two sets may not share. The feature domain is
partitioned into k / 2 + 1 parts (and a few more), so one part at least has
at most one such feature; each part is partitioned into three again, and a
signature is made for each pair of the three: the pair without that feature
agrees in full. So similar sets always share a signature. Sets that do are
compared exactly.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import pick, release_shuffles, text_bytes, tidy, write_table
from geonest.llm.components import connected_components
from geonest.llm.shingles import fingerprint, mix, shingle_sets

SHINGLE = 5
#: The similarity as a percentage.
PERCENT = 75
#: Share of the feature domain (of 256) over which unshared features are counted.
COUNTED = 86
#: Buckets of the size sketch that bounds the distance of two sets.
SKETCH = 256
#: Members of a signature, and features of them, that are compared with each other at once.
BLOCK, BLOCK_SIZE = 512, 1 << 20
#: Most bits of a feature by which a tile compares its members.
KEY_BITS = 24
#: Shingles whose signatures are handed over at once.
ROWS = 1 << 18

PARTS = 3


def band_of(size: int, percent: int = PERCENT) -> tuple[int, int]:
    """Number and largest size of the band that holds ``size``; a band ends
    where a set similar to its smallest may end."""
    number, low = 0, 1
    while True:
        high = low * 100 // percent
        if size <= high:
            return number, high
        number, low = number + 1, high + 1


def _unshared(total: int, percent: int) -> int:
    """Most features that only one of two similar sets of ``total`` features together has."""
    return total * (100 - percent) // (100 + percent)


def partition_count(high: int, percent: int = PERCENT) -> int:
    """First-level parts for two sets of at most ``high`` features each."""
    n = _unshared(2 * high, percent) // 2 + 1
    return n + -(-n * 3 // 100)


def signatures(features: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signatures of a set (sorted distinct uint64) for its own band and the
    next, which meets it in sets of that band.

    A signature over no feature at all says little and is shared by many.
    Two similar sets share another one if either has fewer parts with such a
    signature than parts that must agree; only a set that has more keeps
    these signatures."""
    size = len(features)
    number, high = band_of(size, percent)
    out = []
    for instance, top in ((number, high), (number + 1, (high + 1) * 100 // percent)):
        n = partition_count(top, percent)
        x = mix(features ^ mix(np.full(1, instance + 1, np.uint64)))
        cell = (x % np.uint64(n)).astype(np.int64) * PARTS + ((x >> np.uint64(40)) % np.uint64(PARTS)).astype(np.int64)
        sums, counts = np.zeros(n * PARTS, np.uint64), np.bincount(cell, minlength=n * PARTS).reshape(n, PARTS)
        np.add.at(sums, cell, mix(x + np.uint64(1)))
        sums = sums.reshape(n, PARTS)
        # each signature leaves one of the three second-level parts out
        sums, counts = sums.sum(1, keepdims=True) - sums, counts.sum(1, keepdims=True) - counts
        place = np.arange(n * PARTS, dtype=np.uint64).reshape(n, PARTS) + (np.uint64(instance) << np.uint64(48))
        found = mix(sums ^ mix(place))
        spoiled = _unshared(size + min(size * 100 // percent, top), percent) // 2
        if n - spoiled > int((counts == 0).any(axis=1).sum()):
            found = found[counts > 0]
        out.append(found.ravel())
    return np.concatenate(out)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(features: np.ndarray) -> bytes:
    """Features per bucket, at most 255: the differences of two sketches add
    up to no more than the features that the sets do not share."""
    return np.minimum(np.bincount((features >> np.uint64(24)).astype(np.int64) % SKETCH, minlength=SKETCH), 255).astype(np.uint8).tobytes()


def key_bits(size: int, most: int) -> int:
    """Bits of a feature's short key: five more than the set's size has, so few meet by chance."""
    return min(most, size.bit_length() + 5)


def short_keys(features: np.ndarray, most: int) -> bytes:
    """The last bits of every feature (above 24), sorted, each as the step from
    the one before: a byte below 255, after a byte 255 for each 255 of it."""
    mask = (1 << key_bits(len(features), most)) - 1
    steps = np.diff(np.sort(((features >> np.uint64(24)) & np.uint64(mask)).astype(np.int64)), prepend=0)
    ends = np.cumsum(steps // 255 + 1)
    out = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = steps % 255
    return out.tobytes()


def read_keys(keys: list[bytes]) -> np.ndarray:
    """The keys of several sets, one set after another."""
    steps = np.frombuffer(b"".join(keys), np.uint8)
    total = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])
    sizes = np.array([len(k) for k in keys])
    begin = np.repeat(total[np.cumsum(sizes) - sizes], sizes)
    return (total[1:] - begin)[steps < 255]


@tidy
def _info(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(len(s), *fingerprint(s)) for s in shingle_sets((t.as_py() for t in b.column(1)), size)]
            n, one, two = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True)) if rows else (pa.array([], pa.int64()),) * 3
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n, one, two], ["doc_id", "digest", "n_shingles", "f1", "f2"])

    return run


@tidy
def _counted(size: int):
    """The counted share of each text's features, with the set's name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, rows = [], 0
            for s in shingle_sets((t.as_py() for t in b.column(1)), size):
                one, two = fingerprint(s)
                s = s[(s & np.uint64(0xFF)) < np.uint64(COUNTED)]
                held.append((s, np.full(len(s), one ^ two, np.int64)))
                rows += len(s)
                if rows >= ROWS:
                    yield _feature_rows(held)
                    held, rows = [], 0
            if held:
                yield _feature_rows(held)

    return run


def _feature_rows(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    feature, owner = (np.concatenate(c) for c in zip(*held, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(owner)], ["feature", "owner"])


@tidy
def _sets(size: int, most_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rep, found, sketches, keys = [], [], [], []
            cut = shingle_sets((t.as_py() for t in b.column(1)), size)
            for r, s, one, two in zip(b.column(0), cut, b.column(2), b.column(3), strict=True):
                if fingerprint(s) == (one.as_py(), two.as_py()):
                    rep.append(r.as_py())
                    found.append(s.astype("<u8").tobytes())
                    sketches.append(sketch(s))
                    keys.append(short_keys(s, most_bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep, pa.int64()), *(pa.array(c, pa.binary()) for c in (found, sketches, keys))], ["rep", "features", "sketch", "keys"]
            )

    return run


@tidy
def _signature_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, rows = [], 0
            for r, s in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = signatures(np.frombuffer(s.as_py(), "<u8"), percent).view(np.int64)
                held.append((found, np.full(len(found), r, np.int64)))
                rows += len(found)
                if rows >= ROWS:
                    yield _pair_rows(held, ["sig", "rep"])
                    held, rows = [], 0
            if held:
                yield _pair_rows(held, ["sig", "rep"])

    return run


def _pair_rows(held: list, names: list[str]) -> pa.RecordBatch:
    one, two = (np.concatenate(c) for c in zip(*held, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names)


@tidy
def _near(percent: int):
    """Keeps pairs whose sketches allow similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb = (b.column(i).to_numpy() for i in (2, 3))
            one, two = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH).astype(np.int16) for i in (4, 5))
            ok = np.abs(one - two).sum(1, dtype=np.int64) <= (na + nb) * (100 - percent) // (100 + percent)
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return run


@tidy
def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [
                similar(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), percent)
                for x, y in zip(b.column(2), b.column(3), strict=True)
            ]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The similar ones of the distinct ``pairs`` (``a``, ``b``) of ``sets``:
    first by sketch, then in full; only what passes the first moves whole sets."""

    def side(name: str, column: str) -> DataFrame:
        return sets.select(F.col("rep").alias(name), F.col(column).alias(f"{column}_{name}"))

    def sized(name: str) -> DataFrame:
        return sets.select(F.col("rep").alias(name), (F.length("features") / 8).cast("bigint").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    near = (
        pairs.join(sized("a"), "a").join(sized("b"), "b")
        .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
        .mapInArrow(_near(percent), "a bigint, b bigint")
    )
    both = near.join(side("a", "features"), "a").join(side("b", "features"), "b").select("a", "b", "features_a", "features_b")
    return both.mapInArrow(_verify(percent), "a bigint, b bigint")


@tidy
def _across(percent: int, most: int, every: bool = False):
    """Pairs of two blocks of a signature's members that are in different
    components and may be similar by their short keys. Rows come sorted by
    (sig, i, j); what is held of one such tile is at most two blocks.

    A pair joins its components at once, so a tile gives fewer pairs than it
    has members. With ``every``, components stay as they came and all such
    pairs are given: for the tiles of a pair that the whole features refute."""

    def pairs(t: pa.Table) -> list[tuple[int, int, int]]:
        # a pair across components has a member outside of the largest one: those come first
        _, of, counts = np.unique(t.column("component").to_numpy(), return_inverse=True, return_counts=True)
        largest = of == counts.argmax()
        t = t.take(pa.array(np.argsort(largest, kind="stable")))
        sig, rep, comp, n = (t.column(c).to_numpy() for c in ("sig", "rep", "component", "n"))
        left, right = (t.column(c).to_numpy() for c in ("left", "right"))
        comp, bits = comp.copy(), min(key_bits(int(x), most) for x in n)
        keys = read_keys(t.column("keys").to_pylist()) & ((1 << bits) - 1)
        begin = np.cumsum(n) - n
        held = np.zeros(1 << bits, np.uint8)
        shared: dict[int, np.ndarray] = {}
        out = []
        # pairs clear of the limit first: what they join needs no pair that chance may have lifted over it
        for clear, i in itertools.product((False,) if every else (True, False), range(min(int((~largest).sum()), len(n) - 1))):
            # a pair is compared once, from its first member
            rest = slice(i + 1, None)
            other = (comp[rest] != comp[i]) & (rep[rest] != rep[i]) & ((left[i] & right[rest]) | (left[rest] & right[i]))
            if not other.any():
                continue
            if i not in shared:
                own = keys[begin[i]:begin[i] + n[i]]
                held[own] = 1
                # keys that i has too: no fewer than the features that both have
                at = begin[i + 1]
                shared[i] = np.minimum(np.add.reduceat(held[keys[at:]], begin[rest] - at, dtype=np.int32), n[i]).astype(np.int32)
                held[own] = 0
            both = shared[i] - (n[rest] // 64 + 3) if clear else shared[i].astype(np.int64)
            for k in (np.flatnonzero(other & (100 * both >= percent * (n[rest] + n[i] - both))) + i + 1).tolist():
                if comp[k] != comp[i]:
                    out.append((int(sig[i]), int(min(rep[i], rep[k])), int(max(rep[i], rep[k]))))
                    if not every:
                        comp[comp == comp[k]] = comp[i]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in itertools.chain(batches, [None]):
            t = held if b is None else pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if t is None or not t.num_rows:
                continue
            keys = [t.column(c).to_numpy() for c in ("sig", "i", "j")]
            head = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
            ends = np.append(head[1:], t.num_rows)
            if b is not None:  # the last tile may go on
                held, head, ends = t.slice(head[-1]), head[:-1], ends[:-1]
            found = [p for at, end in zip(head.tolist(), ends.tolist(), strict=True) for p in pairs(t.slice(at, end - at))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["sig", "a", "b"])

    return run


def _label(sets: DataFrame, links: DataFrame) -> DataFrame:
    return sets.join(connected_components(links).withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links between members: the components that these join become one."""
    name = labels.select("rep", "component")
    ends = links.join(name.toDF("a", "ca"), "a").join(name.toDF("b", "cb"), "b")
    low = connected_components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()).toDF("component", "lower")
    return write_table(labels.join(low, "component", "left").withColumn("component", F.coalesce("lower", "component")).drop("lower"), "labels")


def _tiles(members: DataFrame, labelled: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Rows (sig, i, j, rep, component, n, left, right, keys) of the signatures
    whose members are in several components, in tiles of two blocks, sorted."""
    sorted_out = members.select("sig", "rep").join(labelled.select("rep", "component", "n"), "rep")
    mixed = (
        sorted_out.groupBy("sig")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("size"))
        # of two members, the only pair has been compared already
        .where("lo < hi and m > 2")
        .select("sig", F.ceil(F.greatest(F.col("m") / BLOCK, F.col("size") / BLOCK_SIZE)).cast("int").alias("blocks"))
    )
    mixed = write_table(mixed if only is None else mixed.join(only, "sig", "left_semi"), "mixed-signatures")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    tiled = (
        members.join(mixed, "sig")
        .select("sig", "rep", block.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
        .select("sig", "rep", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), (F.col("own") <= F.col("with")).alias("left"), (F.col("own") >= F.col("with")).alias("right"))
        .join(labelled, "rep")
    )
    tiles = tiled.select("sig", "i", "j", "rep", "component", "n", "left", "right", "keys")
    return tiles.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")


def jaccard_groups(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, most_bits: int = KEY_BITS) -> DataFrame:
    """``doc_id``, ``digest`` (SHA-256 of the text), ``n_shingles`` and ``group``
    (a name of the component of the row's set; null without shingles or id)
    for every row of ``docs``; see ``jaccard_components``.

    Equal sets are found by name (two sums of their features and their size)
    and stand as one. A set that has more than the allowed share of features
    that no other set has is alone; this is counted over a part of the
    domain, which can only keep too many. The others get signatures. Members
    of a signature are compared with its smallest member, which settles
    groups of near copies in one row a member; only where that leaves several
    components are the rest compared across these, in tiles of two blocks. A
    tile compares a few bits of every feature (``most_bits`` at most), which never misses a similar
    pair, and gives pairs that join its components, fewer than its members;
    these are compared in full. Where one is refuted (the short keys met by
    chance), the tiles of its signature are gone through again, all pairs
    across the components then reached.
    """
    d = pick(docs, doc_id="doc_id:bigint", text="text:string").withColumn("text", text_bytes("text"))
    info = write_table(
        d.withColumn("digest", F.unhex(F.sha2("text", 256))).mapInArrow(_info(size), "doc_id bigint, digest binary, n_shingles bigint, f1 bigint, f2 bigint"),
        "shingle-info",
    )
    reps = (
        info.where("doc_id is not null and n_shingles > 0")
        .groupBy("f1", "f2", "n_shingles")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("set", F.struct("f1", "f2", "n_shingles"))
    )
    # a set is named by its smallest id, or, where several texts under one id
    # would share the name, all but one by a hash
    named = reps.groupBy("doc_id").agg(F.min("set").alias("named"))
    reps = write_table(
        reps.join(named, "doc_id")
        .withColumn("rep", F.when(F.col("set") == F.col("named"), F.col("doc_id")).otherwise(F.xxhash64("f1", "f2", "n_shingles")))
        .select("f1", "f2", "n_shingles", "doc_id", "rep", F.col("f1").bitwiseXOR(F.col("f2")).alias("owner")),
        "shingle-reps",
    )
    alone = (
        d.where("doc_id is not null").mapInArrow(_counted(size), "feature bigint, owner bigint")
        .groupBy("feature")
        .agg(F.min("owner").alias("owner"), F.max("owner").alias("other"))
        .where("owner = other")
        .groupBy("owner")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    open_reps = write_table(
        reps.join(alone, "owner", "left").where(F.coalesce(F.col("alone"), F.lit(0)) * 100 <= F.col("n_shingles") * (100 - percent)).select("rep", "doc_id", "f1", "f2"),
        "shingle-open",
    )
    release_shuffles(d.sparkSession)
    sets = write_table(
        # the plan of the large sizes at every size
        d.join(open_reps.hint("merge"), "doc_id")
        .select("rep", "text", "f1", "f2")
        .mapInArrow(_sets(size, most_bits), "rep bigint, features binary, sketch binary, keys binary"),
        "shingle-sets",
    )
    release_shuffles(d.sparkSession)
    sigs = write_table(sets.mapInArrow(_signature_rows(percent), "sig bigint, rep bigint"), "signatures")
    # groups with the same members are one: they have the same smallest, number and sum of hashes
    groups = (
        sigs.groupBy("sig")
        .agg(F.min("rep").alias("first"), F.max("rep").alias("last"), F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("members"))
        .where("first < last")
        .groupBy("first", "last", "m", "members")
        .agg(F.min("sig").alias("sig"))
        .select("sig", "first")
    )
    members = write_table(sigs.join(groups, "sig").select("sig", "first", "rep"), "signature-members")
    release_shuffles(d.sparkSession)
    star = members.where("first < rep").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    links = write_table(verified(star, sets, percent), "links")

    labels = _label(sets, links).select("rep", "component", (F.length("features") / 8).cast("bigint").alias("n"), "keys")
    labels = write_table(labels.dropDuplicates(["rep"]), "labels")  # rows that repeat an id and text give their set more than once
    given = write_table(_tiles(members, labels).mapInArrow(_across(percent, most_bits), "sig bigint, a bigint, b bigint"), "joining-pairs")
    release_shuffles(d.sparkSession)
    pairs = given.select("a", "b").distinct()
    true = write_table(verified(pairs, sets, percent), "joining-links")
    labels = _joined(labels, true)
    refuted = write_table(given.join(true, ["a", "b"], "left_anti").select("sig").distinct(), "refuted-signatures")
    if refuted.limit(1).count():
        again = _tiles(members, labels, refuted).mapInArrow(_across(percent, most_bits, every=True), "sig bigint, a bigint, b bigint")
        labels = _joined(labels, write_table(verified(again.select("a", "b").distinct(), sets, percent), "joining-links"))
    group = reps.select("f1", "f2", "n_shingles", "rep").join(labels.select("rep", "component"), "rep", "left").select(
        "f1", "f2", "n_shingles", F.coalesce("component", "rep").alias("group")
    )
    return info.join(group, ["f1", "f2", "n_shingles"], "left").select(
        "doc_id", "digest", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("group")).alias("group")
    )


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    r"""``doc_id``, ``n_shingles`` and ``component_id`` for every row of
    ``docs`` (``doc_id``, ``text``).

    A document's set holds its distinct ``size``-word shingles (words
    ``[^\x20\x09-\x0D]+``, A-Z lowered; with fewer words, the whole
    sequence). Two documents link when 100 * intersection >= ``percent`` *
    union; ``component_id`` is the smallest doc_id that links reach.

    Defined cases: a null or empty text has no shingles and links with
    nothing; rows that repeat an id are judged each by its own text; a row
    without an id takes no part, its component is null;
    an empty table gives no rows; other columns are ignored. Shingles, and
    sets, are told apart by 64-bit hashes.
    """
    rows = write_table(jaccard_groups(docs, percent, size), "groups")
    lowest = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("lowest"))
    return rows.join(lowest, "group", "left").select("doc_id", "n_shingles", F.coalesce("lowest", "doc_id").alias("component_id"))
