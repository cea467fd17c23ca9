"""WARC (9) and best-fit packing (10)."""

import base64
import hashlib
import io
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from geonest.llm.packing import WordEncoder, match_rounds, pack_documents, pack_pieces
from geonest.llm.warc import DICTIONARY_FRAME, archive_pages, build_dictionary, read_archives, read_records, write_archives

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# --- WARC ---------------------------------------------------------------------------


def test_archive_round_trip_and_revisits(spark, tmp_dir):
    rows = [
        (3, "http://a/é x", "<p>same</p>"), (1, None, "<p>same</p>"), (2, "http://b/%20", "other ñ"), (4, "http://c", None), (5, "http://d", ""),
        (6, "http://e\r\nX: y", "z" * 3_000_000), (1, "http://twice", "<p>same</p>"), (None, "http://n", "<p>same</p>"), (None, "http://m", "alone"), (7, "http://f", "a\r\n\r\nb\r\n\r\n"),
    ]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int")
    manifest = write_archives(pages, f"{tmp_dir}/warc", sample_bytes=1 << 16)
    got = read_archives(manifest).collect()
    assert len(got) == len(rows) == sum(r.records for r in manifest.collect())
    first = {"<p>same</p>": 1, "other ñ": 2, "": 4}
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        smallest = min((i for i, _, h in rows if (h or "") == (html or "") and i is not None), default=None)
        kind = "response" if page_id == smallest or smallest is None else "revisit"
        want.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, smallest if kind == "revisit" else None))
        assert first.get(html or "", smallest) == smallest
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(want, key=repr)
    by = {(r.page_id, r.record_type): bytes(r.payload) for r in got if r.record_type == "response"}
    assert by[(6, "response")] == b"z" * 3_000_000 and by[(7, "response")] == b"a\r\n\r\nb\r\n\r\n"
    assert all(r.url is None or r.url.isprintable() for r in got)


def test_archives_have_a_dictionary_frame_and_one_frame_per_record(spark, tmp_dir):
    pages = spark.range(200).selectExpr("id as page_id", "concat('http://x/', id) as url", "concat('<html><body>', repeat(md5(cast(id as string)), 40), '</body></html>') as html")
    for r in write_archives(pages, f"{tmp_dir}/warc", archive_bytes=20_000).collect():
        data = open(r.archive.removeprefix("file://"), "rb").read()
        assert len(data) == r.bytes
        magic, size = struct.unpack("<II", data[:8])
        assert magic == DICTIONARY_FRAME
        dictionary, at, n = zstandard.ZstdCompressionDict(data[8:8 + size]), 8 + size, 0
        while at < len(data):  # each frame alone is one whole record
            d = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            record = d.decompress(data[at:])
            at, n = len(data) - len(d.unused_data), n + 1
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            assert int([x for x in record.split(b"\r\n") if x.startswith(b"Content-Length: ")][0][16:]) == len(record.partition(b"\r\n\r\n")[2]) - 4
        assert n == r.records


def test_archive_cases(spark, tmp_dir):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert archive_pages(spark, none).count() == 0
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in archive_pages(spark, pages, min_revisit_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    with pytest.raises(ValueError):
        list(read_records(io.BytesIO(b"\0" * 16)))
    assert build_dictionary([b"x" * 10]) == b"x" * 10


# --- packing --------------------------------------------------------------------------


def brute_pieces(rows, capacity):
    tok = Tokenizer.from_file(VOCABULARY)
    out = []
    for doc_id, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            fit = capacity
        else:
            gaps.remove(fit)
        gaps.append(fit - n)
    return len(gaps)


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_equals_brute_force_pieces_and_best_fit(spark):
    random.seed(3)
    rows = [(i, " ".join(random.choices(["alpha", "Beta,", "gam-ma", "δέλτα", "it's", "12.5", "x!!"], k=random.choice([0, 1, 5, 30, 31, 100, 400])))) for i in range(300)]
    rows += [(300, None), (301, ""), (301, "twice"), (None, "no id"), (302, "<|endoftext|> <|STARTOFTEXT|> kept"), (303, "word " * 70_000)]
    df = spark.createDataFrame([(i, t, "e", "s", 1) for i, t in rows], "doc_id long, text string, salt string, length string, before long")
    got = pack_documents(df, VOCABULARY, capacity=256).collect()
    want = brute_pieces(rows, 256)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    assert check_places(got, 256) == best_fit_decreasing([w[3] for w in want], 256)
    assert pack_documents(df.limit(0), VOCABULARY).count() == 0


def test_packing_keeps_ids(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in pack_documents(df, VOCABULARY, with_ids=True).collect()}
    assert got == {1: [*Tokenizer.from_file(VOCABULARY).encode("one two three", add_special_tokens=False).ids, 0], 2: [0]}


def test_words_are_encoded_like_whole_texts():
    texts = ["foo's bar.", "a b c'S d''", "x!!!y ...z 12,3.", "ÀÉ ﬁ ǅ straße...", "İstanbul ΑΣ σς", "don't. it's's 're'", "日本語 テスト。", "e\u0301te cafe\u0301.", " \n\t", "<|endoftext|> Hi", "v!1 (w) x-y_z"]
    tok = Tokenizer.from_file(VOCABULARY)
    got = list(WordEncoder(VOCABULARY).texts([t.encode() for t in texts]))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed", range(20))
def test_match_rounds_equal_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 32, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 200))] + [rng.randint(1, capacity)] * rng.randint(0, 60)
    counts = {n: lengths.count(n) for n in set(lengths)}
    matches, n_seq = match_rounds(counts, capacity)
    assert n_seq == best_fit_decreasing(lengths, capacity)
    used = {}
    starts = {}
    for size, rank, seq, offset in matches:
        starts.setdefault(size, []).append((rank, seq, offset))
    for size, found in starts.items():
        found.sort()
        for k, (rank, seq, offset) in enumerate(found):
            for i in range((found[k + 1][0] if k + 1 < len(found) else counts[size]) - rank):
                used.setdefault(seq + i, []).append((offset, size))
    assert set(used) == set(range(n_seq))
    for places in used.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= capacity


def test_one_size_is_ranked_in_salted_parts(spark):
    pieces = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "cast(700 as bigint) as length", "id as ids_crc32")
    got = pack_pieces(pieces, 2048).collect()
    assert check_places(got, 2048) == 2500
    with pytest.raises(ValueError):
        pack_pieces(pieces.withColumn("length", pieces.length + 5000), 2048)


def test_a_word_with_punctuation_is_not_encoded_anew():
    encoder, met = WordEncoder(VOCABULARY), []
    encode = encoder._encode
    encoder._encode = lambda words: met.extend(words) or encode(words)
    texts = ["été allée! Straße", "été, (straße) allée... Été,", "allée? STRASSE straße."]
    got = [np.frombuffer(g, "<u4").tolist() for t in texts for g in encoder.texts([t.encode()])]
    tok = Tokenizer.from_file(VOCABULARY)
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(met) == len(set(met)) and not {"été,".encode(), "allée!".encode(), "allée...".encode(), "allée?".encode(), "straße.".encode()} & set(met)


def test_words_are_kept_within_bounds(monkeypatch):
    monkeypatch.setattr("geonest.llm.packing.WORD_CACHE", 20)
    monkeypatch.setattr("geonest.llm.packing.TEXT_BYTES", 16)
    texts = [" ".join(random.choices(["one", "two,", "Three", "x1", "five.", "", "six " * 9, *map(str, range(30))], k=12)) for _ in range(80)]
    encoder, tok = WordEncoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    got = [np.frombuffer(g, "<u4").tolist() for g in encoder.texts([t.encode() for t in texts])]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(encoder.cache) <= 10 and len(encoder.older) <= 10


def test_the_tokenizer_library_gets_few_words_at_once(monkeypatch):
    monkeypatch.setattr("geonest.llm.packing.CALL_WORDS", 5)
    texts = [" ".join([f"{w}{c}" for w in ["one", "É", "straße", "x1", "мир", "don't", "七", ""] for c in "abcdefgh"])]
    encoder, most = WordEncoder(VOCABULARY), []

    class Counted:
        def __init__(self, tok):
            self.tok = tok

        def encode_batch_fast(self, words, **kwargs):
            most.append(sum(len(w.split()) for w in words))
            return self.tok.encode_batch_fast(words, **kwargs)

    encoder.tok, encoder.letters = Counted(encoder.tok), Counted(encoder.letters)
    got = [np.frombuffer(g, "<u4").tolist() for g in encoder.texts([t.encode() for t in texts])]
    tok = Tokenizer.from_file(VOCABULARY)
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(most) == 64 and max(most) == 5
