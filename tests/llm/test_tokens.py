"""Bit planes, best-fit packing and forced-boundary BPE against the tokenizers library and plain rules."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskflow.llm import bestfit, bitplanes, bpe
from riskflow.llm.encode import Encoder, tokenizer_path

from . import cases


def library(name):
    t = Tokenizer.from_file(tokenizer_path(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def odd_texts(n=1500):
    rng = random.Random(4)
    alphabet = list("aA'sStT mM.,!1٣é É\n\t <|>ΣςİJ̌中​ ß%$\xa0\x1c\x85")
    return [t or "" for _, t in cases.texts()] + ["", "a  <|endoftext|>  b", "don't. it's!! 's 'S x's."] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_cached_encoding_is_the_librarys(name, spaced):
    own, want = Encoder(tokenizer_path(name), spaced), library(name)
    found = odd_texts()
    for _ in range(2):  # from an empty and from a full cache
        for text, ids in zip(found, own.ids(found)):
            assert np.frombuffer(ids, "<u4").tolist() == want(text), repr(text)


class Counted(dict):
    """A cache that counts the questions put to it."""

    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)

    def __contains__(self, key):
        self.asked += 1
        return super().__contains__(key)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_a_batch_asks_for_each_distinct_piece_once(name, spaced):
    own, want = Encoder(tokenizer_path(name), spaced), library(name)
    own.young = Counted()
    found = ["one two, three été", "two one, Three. one"] * 500
    for text, ids in zip(found, own.ids(found), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want(text)
    assert own.young.asked <= 20


def test_line_ends_and_marks_make_no_new_words():
    own, want, seen = Encoder(tokenizer_path("word_bpe_49k.json"), False), library("word_bpe_49k.json"), []
    whole = own.whole
    own.whole = lambda pieces: seen.extend(pieces) or whole(pieces)
    text = "one two.\nÉté one,\ttwo\r\nthree! 中 One"
    assert np.frombuffer(own.ids([text])[0], "<u4").tolist() == want(text)
    assert set(seen) == {"", ".", ",", "!", "中"}
    assert set(own.young) == {"one", "two", "three", "Été", "", ".", ",", "!", "中"}


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoding_of_columns(name, spaced):
    own, want = Encoder(tokenizer_path(name), spaced), library(name)
    column = pa.array(["left out", None, "", " ", "İ. a İ.", "a <|endoftext|>b", "J\u030c. \u212a, Ⱥ.", "x\n\n\u0301y", "left out"]).slice(1, 7)
    for kind in (pa.string(), pa.large_string()):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in own.ids(column.cast(kind))] == [want(t) for t in column.to_pylist()]
    assert own.ids([]) == [] and own.ids([None, ""]) == [b"", b""] and own.ids(pa.array([], pa.string())) == []


def test_forced_boundaries_give_the_librarys_ids():
    vocab, tok = bpe.vocabulary(tokenizer_path("word_bpe_49k.json")), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    assert any(len(vocab.fragments(w)) > 1 for w in ("xq", "qx", "jqz"))
    for text in odd_texts() + ["x" * 3000, "the" * 2000 + "ab" * 500]:
        ids = vocab.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)
        assert vocab.decode(ids) == tok.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("bits", [1, 8])
def test_planes_round_trip(bits, tmp_path):
    rng = np.random.default_rng(1)
    for ids in (np.array([0], np.uint32), rng.integers(0, 49_408, 5000).astype(np.uint32), rng.integers(0, 2**32, 777, dtype=np.uint64).astype(np.uint32), np.zeros(100, np.uint32)):
        assert (bitplanes.ids_of(bitplanes.planes_of(ids, bits), len(ids), bits) == ids).all()
    docs = [(i if i else None, rng.integers(0, 60_000, int(n)).astype("<u4")) for i, n in enumerate(rng.integers(0, 900, 60))]
    writer = bitplanes.Writer(str(tmp_path), block=256, bits=bits)
    for i, ids in docs:
        writer.add(i, ids.tobytes())
    done, before = writer.close(), 0
    reader = bitplanes.Reader(done["file"])
    for (i, ids), (got_id, start, got) in zip(docs, reader.documents(), strict=True):
        assert (got_id, start) == (i, before) and (got == ids).all()
        before += len(ids)
    assert done["ids"] == before and sum(n for n, _ in reader.index) == before


def test_token_files(spark):
    rows, ids_of = cases.texts(), library("word_bpe_49k.json")
    got = bitplanes.read_documents(bitplanes.write_ids(cases.documents(spark), block=512, file_ids=3000)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, t in rows for x in [ids_of(t) + [2]])
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert len({r.file for r in got}) > 1
    assert bitplanes.read_documents(bitplanes.write_ids(cases.documents(spark, []))).count() == 0


def test_plan_is_tight_and_whole():
    rng = random.Random(2)
    for n in (1, 7, 500, 30_000):
        histogram = Counter(rng.randint(1, 1024) for _ in range(n))
        used = defaultdict(list)
        for length, a, b, first, offset in bestfit.plan(histogram):
            for r in range(a, b + 1):
                used[first + r - a].append((offset, length))
        assert sum(map(len, used.values())) == n and Counter(x for v in used.values() for _, x in v) == histogram
        for v in used.values():
            at = 0
            for offset, length in sorted(v):
                assert offset == at
                at += length
            assert at <= 1024
        least = -(-sum(k * v for k, v in histogram.items()) // 1024)
        assert len(used) <= max(least + 2, 1.1 * least)
    assert bestfit.plan({}) == [] and bestfit.cuts(2048, 1024) == [(0, 1024), (1024, 1024)] and bestfit.cuts(1500, 1024) == [(0, 476), (476, 1024)]


def test_packing(spark):
    rows, ids_of = cases.texts(), library("byte_bpe_50k.json")
    got = bestfit.pack(cases.documents(spark)).collect()
    want = Counter()
    for d, t in rows:
        ids = ids_of(t) + [2]
        for k, (at, n) in enumerate(bestfit.cuts(len(ids), 1024)):
            want[d, k, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for v in by.values():
        assert [o for o, _ in sorted(v)] == list(np.cumsum([0, *(n for _, n in sorted(v))])[:-1]) and sum(n for _, n in v) <= 1024
    assert bestfit.pack(cases.documents(spark, [])).count() == 0


def test_encode_and_decode(spark):
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(cases.documents(spark), digests=True).collect())
    want = Counter()
    for d, t in cases.texts():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want
    assert bpe.encode_decode(cases.documents(spark, [])).count() == 0
    full = bpe.encode_decode(cases.documents(spark, [(1, "The cat")])).first()
    assert full.ids == tok.encode("The cat").ids and full.decoded == tok.decode(full.ids)
