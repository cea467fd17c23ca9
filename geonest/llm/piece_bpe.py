r"""SentencePiece encoding and decoding (13) for models of the merge type.

Such a model joins neighbouring symbols, first characters, as long as their
text together is a piece: the pair of the best score first, of equal scores
the leftmost. A sequence of pieces is the encoding of its text exactly if
each two neighbours alone would be encoded as these two. So the encoding is
found from left to right without a queue of merges:

* an Aho-Corasick automaton of all pieces gives the longest one that begins
  at each position;
* a piece may follow another if joining the characters of both again, in
  order of score, ends with these two pieces;
* where it may not, the next shorter piece that begins it is tried; where
  none is left, the position has failed and the piece before it is replaced
  by a shorter one. Failed positions are kept in a bitfield, so none is
  entered twice.

A text is encoded in units that no piece crosses (a run of letters, or of
other characters, with the spaces before it), and the ids of short units are
kept per worker.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import pick

SPACE = "▁"
#: Units, and pairs of pieces, whose answers a worker keeps (about 150 bytes each).
CACHE = 200_000
#: Longest unit that is kept.
KEPT_LENGTH = 32
#: Text characters and ids that are handed over at once.
BATCH_CHARS = 4 << 20
_STATE: dict = {}

# From fine to coarse; the first that cuts no piece is used.
_UNITS = [
    re.compile(rf"{SPACE}*(?:[A-Za-zÀ-ɏ]+|[^{SPACE}\nA-Za-zÀ-ɏ0-9]+|[0-9])|{SPACE}+|\n"),
    re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+"),
    re.compile(r"(?s).+"),
]


def _field(data: bytes, at: int) -> tuple[int, int | bytes, int]:
    """(number, value, end) of the protocol buffer field at ``at``."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, at

    key, at = varint(at)
    kind = key & 7
    if kind == 0:
        value, at = varint(at)
        return key >> 3, value, at
    size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
    return key >> 3, data[at:at + size], at + size


def _fields(data: bytes) -> dict[int, int | bytes]:
    """The last value of each field of a message."""
    out, at = {}, 0
    while at < len(data):
        number, value, at = _field(data, at)
        out[number] = value
    return out


class _Kept(dict):
    """Ids of the units met last; one that is met again outlives the others."""

    def __init__(self, model: "PieceModel"):
        self.model, self.before = model, {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.before.get(unit)
        if ids is None:
            ids = self.model.encode_unit(unit)
        if len(unit) <= KEPT_LENGTH:
            if len(self) >= CACHE:
                self.before = dict(self)
                self.clear()
            self[unit] = ids
        return ids


class PieceModel:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        parts = _fields(sp.serialized_model_proto())
        trainer, rules = _fields(parts.get(2, b"")), _fields(parts.get(3, b""))
        n = sp.get_piece_size()
        self.texts = [sp.id_to_piece(i) for i in range(n)]
        self.size = [len(p) for p in self.texts]
        plain = [not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i)) for i in range(n)]
        supported = (
            trainer.get(3, 1) == 2 and not rules.get(2) and rules.get(3, 1) and not rules.get(4, 1) and rules.get(5, 1)
            and not any(sp.is_unused(i) for i in range(n)) and any(sp.is_byte(i) for i in range(n))
        )
        if not supported:
            raise ValueError(f"{path}: needs a merge-type model that falls back to bytes, adds a space in front and changes nothing else")
        self.score = {p: -sp.get_score(i) for i, p in enumerate(self.texts) if plain[i]}
        self.id = {p: i for i, p in enumerate(self.texts) if plain[i]}
        self.chars = {p for p in self.id if len(p) == 1}
        bytes_at = {int(p[3:5], 16): i for i, p in enumerate(self.texts) if sp.is_byte(i)}
        self.byte_id = [bytes_at[b] for b in range(256)]
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.data = [p.replace(SPACE, " ").encode() for p in self.texts]
        for b, i in bytes_at.items():
            self.data[i] = bytes([b])
        if sp.unk_id() >= 0:
            self.data[sp.unk_id()] = trainer.get(44, " ⁇ ".encode())
        self.is_byte = bytearray(sp.is_byte(i) for i in range(n))
        self.first_space = {i for i in range(n) if self.texts[i].startswith(SPACE)}
        automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            automaton.add_word(p, (i, len(p) - 1))
        automaton.make_automaton()
        self.automaton = automaton
        self.units = next(u for u in _UNITS if all(u.findall(p) == [p] for p in self.id))
        self.shorter: dict[int, int] = {}
        self.made: dict[int, list | None] = {}
        self.pairs: dict[int, bool] = {}
        self.kept = _Kept(self)

    def merge(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """The pieces of ``text`` by joining its characters in order of score;
        and the score of each joining with the first and last part after it."""
        parts, score, steps = list(text), self.score.get, []
        costs = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, 0
            for i, c in enumerate(costs):
                if c is not None and (best is None or c < best):
                    best, at = c, i
            if best is None:
                return parts, steps
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))
            del costs[at]
            if at:
                costs[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(costs):
                costs[at] = score(parts[at] + parts[at + 1])

    def _steps(self, piece: int) -> list[tuple[float, str, str]] | None:
        """The joinings that make a piece, or None if its text is encoded otherwise."""
        if piece not in self.made:
            text = self.texts[piece]
            parts, steps = self.merge(text)
            self.made[piece] = steps if parts == [text] else None
        return self.made[piece]

    def may_follow(self, before: int, piece: int) -> bool:
        """Whether ``piece`` (at the start of a text, for ``before`` -1) stays
        apart from the piece before it. Both are joined again side by side,
        the better score first, of equal ones the leftmost; they stay apart
        unless the parts at their common edge are joined on the way."""
        right = self._steps(piece)
        if right is None:
            return False
        if before < 0:
            return True
        left, score = self.made[before], self.score.get
        a, b = self.texts[before][-1], self.texts[piece][0]
        i, j, m, n = 0, 0, len(left), len(right)
        edge = score(a + b)
        while True:
            one = left[i][0] if i < m else None
            two = right[j][0] if j < n else None
            if edge is not None and (one is None or edge < one) and (two is None or edge <= two):
                return False
            if one is None and two is None:
                return True
            if two is None or (one is not None and one <= two):
                last = left[i][2]
                i += 1
                if last != a:
                    a = last
                    edge = score(a + b)
            else:
                first = right[j][1]
                j += 1
                if first != b:
                    b = first
                    edge = score(a + b)

    def next_shorter(self, piece: int) -> int:
        """The longest piece that begins ``piece``, but itself; -1 if none does."""
        p = self.texts[piece]
        answer = self.shorter[piece] = next((self.id[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id), -1)
        return answer

    def encode_run(self, text: str) -> list[int]:
        """Ids of a text of known characters."""
        n, size, shorter, pairs, total = len(text), self.size, self.shorter, self.pairs, len(self.texts)
        longest = [-1] * n
        for end, (piece, back) in self.automaton.iter(text):  # ends rise, so the last match of a start is its longest
            longest[end - back] = piece
        failed = bytearray((n >> 3) + 1)
        out, at, piece, before = [], 0, longest[0], -1
        while at < n:
            while piece >= 0:
                end = at + size[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    key = before * total + piece
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= CACHE:
                            pairs.clear()
                        fits = pairs[key] = self.may_follow(before, piece)
                    if fits:
                        break
                follower = shorter.get(piece)
                piece = self.next_shorter(piece) if follower is None else follower
            if piece >= 0:
                out.append(piece)
                before, at = piece, end
                piece = longest[at] if at < n else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= size[piece]
                before = out[-1] if out else -1
        return out

    def encode_unit(self, unit: str) -> bytes:
        """Little-endian ids of a unit."""
        if self.chars.issuperset(unit):
            return array("i", self.encode_run(unit)).tobytes()
        out, known, run = array("i"), self.chars, []
        for c in unit:  # a character without a piece stands as its bytes
            if c in known:
                run.append(c)
                continue
            if run:
                out.extend(self.encode_run("".join(run)))
                run = []
            out.extend(self.byte_id[b] for b in c.encode("utf-8", "replace"))
        if run:
            out.extend(self.encode_run("".join(run)))
        return out.tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers, one after another."""
        if not text:
            return b""
        return b"".join(map(self.kept.__getitem__, self.units.findall(SPACE + text.replace(" ", SPACE))))

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: the space in front that encoding adds goes;
        bytes that are no UTF-8 become U+FFFD each."""
        if not self.control.isdisjoint(ids):
            return self._mend(ids)
        data = b"".join(map(self.data.__getitem__, ids))
        if ids and ids[0] in self.first_space:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._mend(ids)

    def _mend(self, ids: list[int]) -> str:
        """``decode`` where a run of bytes is no UTF-8 or control ids, which end such a run, are present."""
        out, run, begun = [], b"", False
        for i in ids:
            if self.is_byte[i]:
                run += self.data[i]
                begun = True
                continue
            out.append(_whole_characters(run))
            run = b""
            if i not in self.control:
                out.append(self.data[i][0 if begun or i not in self.first_space else 1:].decode())
                begun = True
        return "".join([*out, _whole_characters(run)])


def _whole_characters(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


def model_at(path: str) -> PieceModel:
    """The model of a file, read once per worker."""
    if path not in _STATE:
        _STATE.clear()
        _STATE[path] = PieceModel(path)
    return _STATE[path]


def _slices(column: pa.Array, size) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``BATCH_CHARS`` together, or of one row."""
    at = held = 0
    for i in range(len(column)):
        n = size(column[i])
        if i > at and held + n > BATCH_CHARS:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(column):
        yield at, len(column)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for b in batches:
            for lo, hi in _slices(b.column(1), lambda t: len(t.as_buffer())):
                found = [model.encode(t.as_buffer().to_pybytes().decode("utf-8", "replace")) for t in b.column(1)[lo:hi]]
                ends = np.cumsum([0, *(len(ids) // 4 for ids in found)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], lists], ["doc_id", "ids"])

    return run


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) of every row of ``docs`` (``doc_id``,
    ``text``), encoded as the model at ``model_path`` has it, without begin or
    end ids. The file must be at that path on every executor.

    Defined cases: a null or empty text has no ids; rows that repeat an id,
    or have none, are encoded row by row; an empty table gives no rows; other
    columns are ignored; a text of any length is encoded whole, in memory in
    proportion to it; bytes that are no UTF-8 count as U+FFFD."""
    d = pick(docs, doc_id="doc_id:bigint", text="text:string")
    return d.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(
        _encode(model_path), "doc_id bigint, ids array<int>"
    )


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for b in batches:
            for lo, hi in _slices(b.column(1), lambda ids: 4 * len(ids) if ids.is_valid else 0):
                part = b.slice(lo, hi - lo)
                texts = [model.decode(ids or []) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return run


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``ids``, ``text`` of every row of ``encoded`` (``doc_id``,
    ``ids``): the text that the ids stand for. Null or no ids give the empty
    text, control ids nothing, the unknown id the model's mark for it."""
    e = encoded.select(encoded["doc_id"].cast("bigint").alias("doc_id"), encoded["ids"].cast("array<int>").alias("ids"))
    return e.mapInArrow(_decode(model_path), "doc_id bigint, ids array<int>, text string")
