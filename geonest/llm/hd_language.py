"""Language ID (8) by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram's vector binds
its letters' vectors, each permuted (rotated) by its place, by elementwise
product; a text's vector bundles (adds) its n-grams' vectors. A language's
prototype bundles the texts that are known to be in it. A text gets the
language whose prototype has the highest cosine with its vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geonest.llm.common import id_remainder, pick, tidy, worker_state

DIM = 1024
N = 3
UNKNOWN = "und"
#: Distinct n-grams whose bound vectors a worker keeps (DIM bytes each).
NGRAM_CACHE = 16_000
#: Texts bundled together in one product.
DOCS = 64

_WORD = regex.compile(r"\p{L}+")


class Profiles:
    """Letter and n-gram vectors, the same in every worker."""

    def __init__(self, dim: int, n: int):
        self.dim, self.n = dim, n
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.ngrams = np.zeros((1024, dim), np.int8)

    def letter(self, code: int) -> np.ndarray:
        v = self.letters.get(code)
        if v is None:
            bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, self.dim)
            v = self.letters[code] = (2 * bits - 1).astype(np.float32)
        return v

    def bind(self, key: int) -> np.ndarray:
        """The vector of an n-gram: its letters' vectors, rotated by place and multiplied."""
        v = np.ones(self.dim, np.float32)
        for place in range(self.n):
            v = v * np.roll(self.letter((key >> 21 * place) & 0x1FFFFF), place)
        return v

    def columns(self, keys: np.ndarray) -> np.ndarray:
        """Rows of ``self.ngrams`` that hold the vectors of ``keys``."""
        if len(self.rows) + len(keys) > NGRAM_CACHE:
            self.rows.clear()
        for k in keys.tolist():
            if k not in self.rows:
                at = len(self.rows)
                if at >= len(self.ngrams):
                    self.ngrams = np.concatenate([self.ngrams, np.zeros_like(self.ngrams)])
                self.ngrams[at] = self.bind(k)
                self.rows[k] = at
        return np.fromiter(map(self.rows.__getitem__, keys.tolist()), np.int64, len(keys))

    def grams(self, text: str) -> np.ndarray:
        """n-gram keys of a text's lower-cased letters, words parted by a space."""
        words = _WORD.findall(text.lower())
        if not words:
            return np.zeros(0, np.int64)
        codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), "<u4").astype(np.int64)
        keys = np.zeros(max(0, len(codes) - self.n + 1), np.int64)
        for place in range(self.n):
            keys |= codes[place:len(keys) + place] << 21 * place
        return keys

    def bundle(self, texts: list[str]) -> np.ndarray:
        """The vectors of the texts, one row each (all zero without letters)."""
        out = np.zeros((len(texts), self.dim), np.float32)
        found = [self.grams(t) for t in texts]
        if not sum(map(len, found)):
            return out
        distinct, at = np.unique(np.concatenate(found), return_inverse=True)
        doc = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        step = NGRAM_CACHE // 4
        counts = np.bincount(doc * len(distinct) + at, minlength=len(texts) * len(distinct)).reshape(len(texts), -1).astype(np.float32)
        for lo in range(0, len(distinct), step):
            out += counts[:, lo:lo + step] @ self.ngrams_of(distinct[lo:lo + step])
        return out

    def ngrams_of(self, keys: np.ndarray) -> np.ndarray:
        at = self.columns(keys)
        return self.ngrams[at].astype(np.float32)


def _profiles(dim: int, n: int) -> Profiles:
    return worker_state(__name__, (dim, n), lambda: Profiles(dim, n))


def _texts(b: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for at in range(0, b.num_rows, DOCS):
        part = b.slice(at, DOCS)
        yield part, [t or "" for t in part.column(column).to_pylist()]


@tidy
def _learn(dim: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, sums = _profiles(dim, n), {}
        for b in batches:
            for part, texts in _texts(b, 1):
                vectors = p.bundle(texts)
                norm = np.linalg.norm(vectors, axis=1, keepdims=True)
                unit = vectors / np.maximum(norm, 1e-9)
                for lang, v in zip(part.column(0).to_pylist(), unit, strict=True):
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
                if len(sums) > 256:  # many labels: hand over what there is
                    yield _sums(sums)
                    sums = {}
        if sums:
            yield _sums(sums)

    return run


def _sums(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"]
    )


def learn_prototypes(docs: DataFrame, dim: int = DIM, n: int = N) -> dict[str, np.ndarray]:
    """Unit prototype vectors by language from ``docs`` (``text``, ``lang``;
    rows with a null lang or text teach nothing). Each task bundles its own
    rows; Spark adds the bundles by language and component, so the driver
    gets ``dim`` numbers a language."""
    d = pick(docs, lang="lang:string", text="text:string").where("lang is not null and text is not null")
    sums = (
        d.mapInArrow(_learn(dim, n), "lang string, v array<double>")
        .select("lang", F.posexplode("v").alias("at", "x"))
        .groupBy("lang", "at")
        .agg(F.sum("x").alias("x"))
    )
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["lang"], np.zeros(dim))[r["at"]] = r["x"]
    return {k: v / max(np.linalg.norm(v), 1e-9) for k, v in sorted(out.items())}


@tidy
def _predict(prototypes: dict[str, np.ndarray], dim: int, n: int):
    names = list(prototypes)
    table = np.array([prototypes[k] for k in names], np.float32).reshape(-1, dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _profiles(dim, n)
        for b in batches:
            for part, texts in _texts(b, 1):
                vectors = p.bundle(texts)
                norm = np.linalg.norm(vectors, axis=1)
                if names:
                    cos = vectors @ table.T / np.maximum(norm, 1e-9)[:, None]
                    best, top = cos.argmax(1), np.clip(cos.max(1), 0, 1)
                else:
                    best, top = np.zeros(len(texts), int), np.zeros(len(texts))
                known = (norm > 0) & bool(names)
                found = pa.array([names[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)], pa.string())
                score = pa.array(np.where(known, top, 0.0).astype(float))
                rest = part.columns[2:]
                yield pa.RecordBatch.from_arrays([part.column(0), *rest, found, score], names=["doc_id", *part.schema.names[2:], "lang_pred", "score"])

    return run


def predict_language(docs: DataFrame, prototypes: dict[str, np.ndarray], n: int = N, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the cosine with that
    language's prototype, 0 to 1) for every row of ``docs`` (``doc_id``,
    ``text``), and its columns named in ``keep`` as they are. Whole texts are
    read; only letters (any script, lower-cased) and word breaks count.

    Defined cases: ``und`` with score 0 for a null text, one without a
    letter, or when no language was learned; ties go to the language that
    sorts first; repeated ids are scored row by row; a null id stays null; an
    empty table gives no rows; other columns are ignored.
    """
    dim = len(next(iter(prototypes.values()))) if prototypes else DIM
    d = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("_read_text"), *(docs[c] for c in keep))
    kept = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return d.mapInArrow(_predict(prototypes, dim, n), f"doc_id bigint, {kept}lang_pred string, score double")


def identify_languages(docs: DataFrame, modulus: int = 4, held_out: int = 2, dim: int = DIM, n: int = N, keep: tuple[str, ...] = ()) -> DataFrame:
    """Learn from the documents whose crc32(doc_id) modulo ``modulus`` is not
    ``held_out`` (a row without an id teaches nothing), then predict all:
    adds ``held_out`` (false without an id)."""
    d = pick(docs, doc_id="doc_id:bigint", text="text:string", lang="lang:string")
    prototypes = learn_prototypes(d.where(id_remainder("doc_id", modulus) != held_out), dim, n)
    out = predict_language(docs, prototypes, n, keep)
    is_held = F.coalesce(id_remainder("doc_id", modulus) == held_out, F.lit(False))
    return out.select("doc_id", is_held.alias("held_out"), "lang_pred", "score", *keep)
