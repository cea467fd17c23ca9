"""Multi-line JSON read by byte ranges (SC1, TR5; GE2, GE4 for documents larger than a task).

A multi-line file has no line ends to cut at, so Spark's JSON source reads it
whole in one task. Here the text source cuts it instead, at the braces that
its splits meet (``lineSep``), and what a split means is found out in three
passes, each with a task per split:

1. Quotes and brackets are counted. Whether a split begins inside a string,
   and how deep, follows from the sums of the splits before it (a prefix
   scan over one row per split).
2. With that known, each split names the last bracket it opens at each
   shallow depth; a second scan gives every split the brackets that are open
   where it begins.
3. Each split then hands out its units. A unit is a document, or an element
   of a nested array that ``levels`` names; its text is its own, the elements
   of such an array are units themselves and leave ``[]``. What a split
   holds of a unit that goes on in another is a fragment; fragments of a unit
   are put together afterwards, so only these are shuffled.

No task holds more than a batch of its split and the text of units that are
open, and a document of any size arrives as its own fields and its elements.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geonest import schemas as S
from geonest.session import new_scratch_dir

CUT = "}"
#: Splits whose state the driver and every task hold at once (some 200 bytes each); files are taken in groups beyond.
HELD_SPLITS = 1 << 18
#: Bits of an id that give the place within a split; the number of the split is above.
PLACE_BITS = 40
#: Rows and bytes of units handed over at once.
UNITS, UNIT_BYTES = 4096, 4 << 20

_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_QUOTE = ord('"')
_STEP = np.zeros(256, np.int64)
_STEP[[ord(c) for c in "{["]] = 1
_STEP[[ord(c) for c in "}]"]] = -1
_BLANK = b" \t\r\n,"


def _records(spark: SparkSession, path: str, part: tuple[int, int] | None = None) -> DataFrame:
    """``file``, ``size``, ``split`` (where it begins) and ``value`` (the text up to
    the next brace, without it). Rows of a split come together and in order."""
    meta = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_size", "size"), ("file_block_start", "split"))]
    rows = spark.read.text(path, lineSep=CUT, recursiveFileLookup=True).select(*meta, F.col("value").cast("binary").alias("value"))
    if part is not None and part[1] > 1:
        rows = rows.where(F.pmod(F.xxhash64("file"), F.lit(part[1])) == part[0])
    return rows


def _split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, size, split, bytes) in order, each of one split and one batch."""
    for b in batches:
        if not b.num_rows:
            continue
        files, splits = b.column(0).dictionary_encode(), b.column(2).to_numpy()
        codes = files.indices.to_numpy()
        heads = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (splits[1:] != splits[:-1])]))
        for lo, hi in zip(heads.tolist(), [*heads[1:].tolist(), b.num_rows], strict=True):
            data = CUT.encode().join([*b.column(3)[lo:hi].to_pylist(), b""])
            yield files.dictionary[int(codes[lo])].as_py(), b.column(1)[lo].as_py(), int(splits[lo]), data


def _signs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the quotes; places, steps and the parity of the quotes before them of the brackets."""
    plain = _ESCAPE.sub(b"..", data) if b"\\" in data else data
    a = np.frombuffer(plain, np.uint8)
    quotes, step = np.flatnonzero(a == _QUOTE), _STEP[a]
    brackets = np.flatnonzero(step)
    return quotes, brackets, step[brackets], np.searchsorted(quotes, brackets) & 1


def _structure(data: bytes, parity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the quotes, and places and steps of the brackets outside of
    strings, where ``parity`` tells whether ``data`` begins inside one."""
    quotes, at, step, odd = _signs(data)
    return quotes, at[odd == parity], step[odd == parity]


_SUMS = "file string, size bigint, split bigint, n_bytes bigint, quotes bigint, outside bigint, inside bigint"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: its bytes and quotes, and what it adds to the depth if
    it begins outside of a string, or inside one."""
    now, out = None, []

    def batch() -> pa.RecordBatch:
        names = [c.split()[0] for c in _SUMS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    for file, size, split, data in _split_runs(batches):
        if now is None or now[0] != file or now[2] != split:
            now = [file, size, split, 0, 0, 0, 0]
            out.append(now)
        quotes, _, step, odd = _signs(data)
        odd ^= now[4] & 1
        for parity in (0, 1):
            now[5 + parity] += int(step[odd == parity].sum())
        now[3] += len(data)
        now[4] += len(quotes)
    if out:
        yield batch()


class _Entry:
    """What is known of a split where it begins."""

    __slots__ = ("number", "parity", "depth", "stack")

    def __init__(self, number: int = 0, parity: int = 0, depth: int = 0, stack: tuple = ()):
        self.number, self.parity, self.depth, self.stack = number, parity, depth, stack


def _begin(sums: list) -> dict[tuple[str, int], _Entry]:
    """Scan of the first pass: string state and depth at every split's begin."""
    out, file, total = {}, None, 0
    for r in [*sums, None]:
        if r is None or r["file"] != file:
            if file is not None:
                # the last record of a file has a brace after it that may not be there
                # (a compressed file's size does not tell)
                ends = {0: (0,), 1: (-1,)}.get(total - size, (0, -1))
                if parity or depth not in ends:
                    raise ValueError(f"{file}: the JSON text ends inside a string or a bracket, or closes what it never opened")
            if r is None:
                break
            file, size, number, parity, depth, total = r["file"], r["size"], 0, 0, 0, 0
        out[file, r["split"]] = _Entry(number, parity, depth)
        depth += r["inside"] if parity else r["outside"]
        parity ^= r["quotes"] & 1
        total += r["n_bytes"]
        number += 1
    return out


def _key_before(data: bytes, quotes: np.ndarray, at: int) -> str | None:
    """The member name whose value begins at ``at``; None for an element."""
    end = at - 1
    while end >= 0 and data[end:end + 1].isspace():
        end -= 1
    if end < 0 or data[end:end + 1] != b":":
        return None
    end -= 1
    while end >= 0 and data[end:end + 1].isspace():
        end -= 1
    k = int(np.searchsorted(quotes, end))
    if k == 0 or k >= len(quotes) or quotes[k] != end:
        return None  # cut by a brace in the name itself
    return json.loads(data[quotes[k - 1]:end + 1])


_OPENED = "file string, split bigint, depth int, kind string, name string, place bigint"


def _open_brackets(entries, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, out = None, {}, []

        def close() -> None:
            out.extend((*now, d, *found) for d, found in last.items())

        for file, _, split, data in _split_runs(batches):
            if now != (file, split):
                if now is not None:
                    close()
                now, last, base = (file, split), {}, 0
                e = entries.value.get(now) or _Entry()
                parity, depth = e.parity, e.depth
            quotes, at, step = _structure(data, parity)
            own = depth + np.cumsum(step) + (step < 0)
            for d in range(1, limit + 1):
                found = np.flatnonzero((own == d) & (step > 0))
                if len(found):
                    p = int(at[found[-1]])
                    kind = data[p:p + 1].decode()
                    last[d] = (kind, _key_before(data, quotes, p) if kind == "[" else None, base + p)
            depth, parity, base = depth + int(step.sum()), parity ^ len(quotes) & 1, base + len(data)
        if now is not None:
            close()
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64()), strict=True)],
                [c.split()[0] for c in _OPENED.split(", ")],
            )

    return run


def _with_stacks(entries: dict[tuple[str, int], _Entry], opened: list, limit: int) -> None:
    """Scan of the second pass: the brackets (kind, name, id) that are open at every split's begin."""
    per_split: dict[tuple[str, int], dict[int, tuple]] = {}
    for r in opened:
        key = (r["file"], r["split"])
        per_split.setdefault(key, {})[r["depth"]] = (r["kind"], r["name"], entries[key].number << PLACE_BITS | r["place"])
    stack: dict[int, tuple] = {}
    for key, e in entries.items():
        if e.number == 0:
            stack = {}
        e.stack = tuple(stack[d] for d in range(1, min(e.depth, limit) + 1))
        stack.update(per_split.get(key, {}))


class _Open:
    """An open bracket that matters: a unit, or an array whose elements are units."""

    __slots__ = ("is_unit", "level", "id", "parent", "parts", "begun")

    def __init__(self, is_unit: bool, level: int, id_: int | None, parent: int | None, begun: bool = True):
        self.is_unit, self.level, self.id, self.parent, self.begun, self.parts = is_unit, level, id_, parent, begun, []


class _Cutter:
    """Cuts one split into units. ``out`` gets (level, id, parent, whole, text)."""

    def __init__(self, file: str, entry: _Entry, levels: tuple[str, ...], out: list):
        self.file, self.levels, self.out, self.number = file, levels, out, entry.number
        self.parity, self.depth, self.base, self.limit = entry.parity, entry.depth, 0, 2 + 2 * len(levels)
        self.stack: list[_Open] = []
        self.skip = 0  # depth of an open bracket that is part of a unit's own text
        for d, (kind, name, id_) in enumerate(entry.stack, 1):
            if not self._enter(kind, name, id_, begun=False):
                self.skip = d
                break

    def _enter(self, kind: str, name: str | None, id_: int, begun: bool = True) -> bool:
        """Open a unit or an array of units; False if the bracket is neither."""
        top = self.stack[-1] if self.stack else None
        if top is None or not top.is_unit:
            level = top.level if top else 0
            if kind == "{":
                parent = next((o.id for o in reversed(self.stack) if o.is_unit), None)
                self.stack.append(_Open(True, level, id_, parent, begun))
                return True
            if top is None:
                self.stack.append(_Open(False, 0, None, None))
                return True
            raise ValueError(f"{self.file}: an array whose elements are read as documents holds an array")
        if kind == "[" and top.level < len(self.levels) and name == self.levels[top.level]:
            self.stack.append(_Open(False, top.level + 1, None, None))
            return True
        return False

    def _blank(self, data: bytes) -> None:
        if data.strip(_BLANK):
            raise ValueError(f"{self.file}: an element is no JSON object: {data[:60]!r}")

    def cut(self, data: bytes) -> None:
        quotes, at, step = _structure(data, self.parity)
        own = self.depth + np.cumsum(step) + (step < 0)
        shallow = own <= self.limit
        mark = 0  # where the text of the innermost unit, or the gap between units, begins
        for p, s, d in zip(at[shallow].tolist(), step[shallow].tolist(), own[shallow].tolist(), strict=True):
            if self.skip:
                if s < 0 and d == self.skip:
                    self.skip = 0
                continue
            top = self.stack[-1] if self.stack else None
            if s > 0:
                kind = data[p:p + 1].decode()
                name = _key_before(data, quotes, p) if kind == "[" and top is not None and top.is_unit else None
                if top is None or not top.is_unit:
                    self._blank(data[mark:p])
                if not self._enter(kind, name, self.number << PLACE_BITS | self.base + p):
                    self.skip = d
                elif top is not None and top.is_unit:
                    top.parts.append(data[mark:p + 1])
                    mark = p + 1
                else:
                    mark = p if self.stack[-1].is_unit else p + 1
            elif top is None:
                pass  # the brace after the last record
            elif top.is_unit:
                if data[p:p + 1] != b"}":
                    raise ValueError(f"{self.file}: an object ends with a square bracket")
                top.parts.append(data[mark:p + 1])
                self.stack.pop()
                self._hand_out(top, whole=top.begun)
                mark = p + 1
            else:
                if data[p:p + 1] != b"]":
                    raise ValueError(f"{self.file}: an array ends with a brace")
                self._blank(data[mark:p])
                self.stack.pop()
                mark = p if self.stack else p + 1
        top = self.stack[-1] if self.stack else None
        if top is not None:
            if top.is_unit:
                top.parts.append(data[mark:])
            else:
                self._blank(data[mark:])
        self.depth, self.parity, self.base = self.depth + int(step.sum()), self.parity ^ len(quotes) & 1, self.base + len(data)

    def end(self) -> None:
        for o in self.stack:
            if o.is_unit:
                self._hand_out(o, whole=False)

    def _hand_out(self, o: _Open, whole: bool) -> None:
        text = b"".join(o.parts)
        if whole or text:
            self.out.append((self.file, o.level, o.id, o.parent, None if whole else self.number, text))


_UNIT = "file string, level int, id bigint, parent bigint, fragment int, text string"
_UNIT_TYPES = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())


def _cut_units(entries, levels: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, cutter = [], None, None

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _UNIT_TYPES, strict=True)]
            columns[-1] = columns[-1].cast(pa.string())  # also checks the UTF-8
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _UNIT.split(", ")])

        for file, _, split, data in _split_runs(batches):
            if now != (file, split):
                if cutter is not None:
                    cutter.end()
                now = (file, split)
                cutter = _Cutter(file, entries.value.get(now) or _Entry(), levels, out)
            cutter.cut(data)
            while len(out) >= UNITS or (out and sum(len(r[-1]) for r in out) >= UNIT_BYTES):
                yield batch()
                out.clear()
        if cutter is not None:
            cutter.end()
        if out:
            yield batch()

    return run


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_json_units(spark: SparkSession, path: str, levels: tuple[str, ...] = ()) -> DataFrame:
    """``file``, ``level``, ``id``, ``parent``, ``text``: the units of the
    multi-line JSON files at ``path`` (a file or a folder).

    Level 0 are the documents: the objects of a file's array, or its only
    object. ``levels`` names nested arrays from the outside in: the elements
    of a document's array ``levels[0]`` are the units of level 1, and so on;
    in the text of the unit above the array is empty. ``id`` tells the units
    of a file apart, in the order in which they begin; ``parent`` is the id of
    the unit above.

    A file that ends too early, or an element of such an array that is no
    object, is an error. Files are UTF-8. A file's splits are the session's
    (``spark.sql.files.maxPartitionBytes``)."""
    if any(CUT in name for name in levels):
        raise ValueError("a level's name must not hold a brace")
    root = new_scratch_dir(spark, "json-units")
    limit = 2 + 2 * len(levels)
    sums = _written(_records(spark, path).mapInArrow(_count, _SUMS), f"{root}/sums")
    groups = max(1, -(-sums.count() // HELD_SPLITS))
    units = None
    for g in range(groups):
        mine = sums.where(F.pmod(F.xxhash64("file"), F.lit(groups)) == g) if groups > 1 else sums
        entries = _begin(mine.orderBy("file", "split").collect())
        held = spark.sparkContext.broadcast(entries)
        opened = _records(spark, path, (g, groups)).mapInArrow(_open_brackets(held, limit), _OPENED)
        _with_stacks(entries, opened.collect(), limit)
        held.unpersist()
        held = spark.sparkContext.broadcast(entries)
        part = _written(_records(spark, path, (g, groups)).mapInArrow(_cut_units(held, tuple(levels)), _UNIT), f"{root}/units-{g}")
        held.unpersist()
        units = part if units is None else units.unionByName(part)
    whole = units.where("fragment is null").select("file", "level", "id", "parent", "text")
    cut = units.where("fragment is not null").groupBy("file", "level", "id", "parent").agg(F.sort_array(F.collect_list(F.struct("fragment", "text"))).alias("f"))
    return whole.unionByName(cut.select("file", "level", "id", "parent", F.array_join("f.text", "").alias("text")))


def read_json_ranges(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """SC1 for files of any size: the rows of ``read_multiline_json`` with a
    schema, read by a task per split."""
    return read_json_units(spark, path).select(F.from_json("text", schema, {"mode": mode}).alias("d")).select("d.*")


LOCATION_LEVELS = ("states", "cities")


def read_location_pieces(spark: SparkSession, path: str, schema: T.StructType = S.COUNTRY) -> dict[str, DataFrame]:
    """GE2, GE4 for documents that no task can hold: for each table the
    documents in pieces, each a country with its own fields and at most one
    state, and of that at most one city. The flatten operators give for
    ``countries``, ``states`` and ``cities`` the rows of the whole documents."""
    units = read_json_units(spark, path, LOCATION_LEVELS)
    state = schema["states"].dataType.elementType
    city = state["cities"].dataType.elementType

    def parsed(level: int, kind: T.StructType, name: str) -> DataFrame:
        return units.where(F.col("level") == level).select(
            "file", F.col("id").alias(f"{name}_key"), F.col("parent").alias("parent"), F.from_json("text", kind, {"mode": "FAILFAST"}).alias(name)
        )

    countries, states, cities = (
        _written(parsed(level, kind, name), f"{new_scratch_dir(spark, 'pieces')}/{name}")
        for level, kind, name in ((0, schema, "country"), (1, state, "state"), (2, city, "city"))
    )
    state_rows = _under(states, countries, "country").withColumn("states", F.array("state"))
    none = countries.join(states.select("file", F.col("parent").alias("country_key")), ["file", "country_key"], "left_anti")
    childless = none.select(F.col("country.*"))
    with_states = state_rows.select(F.col("country").withField("states", F.col("states")).alias("country"), "state", "file", "state_key")
    with_cities = _under(cities, with_states, "state").select(
        F.col("country").withField("states", F.array(F.col("state").withField("cities", F.array("city")))).alias("country")
    )
    cityless = with_states.join(cities.select("file", F.col("parent").alias("state_key")), ["file", "state_key"], "left_anti")
    return {
        "countries": countries.select("country.*"),
        "states": with_states.select("country.*").union(childless),
        "cities": with_cities.select("country.*").union(cityless.select("country.*")).union(childless),
    }


def _under(children: DataFrame, parents: DataFrame, name: str) -> DataFrame:
    """Children beside their parent: an inner join, which adaptive execution
    can split for a parent with many children (an outer one it could not)."""
    return children.drop(f"{name}_key").withColumnRenamed("parent", f"{name}_key").join(parents.drop("parent"), ["file", f"{name}_key"])
