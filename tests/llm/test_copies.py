"""Grace deduplication and the n-gram join against comparing everything with everything."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskflow.llm import fsjoin, grace
from riskflow.llm.tables import stored

from . import cases


def groups(rows):
    same = {}
    for d, t in rows:
        same.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(d)
    return same


def test_table_compares_contents():
    table = grace.Table(4)
    assert [table.put(7, b"a"), table.put(7, b"b"), table.put(7, b"a"), table.put(-1, b"a")] == [(0, True), (1, True), (0, False), (2, True)]
    for i in range(500):
        assert table.put(i % 3, b"%d" % i) == (3 + i, True)
    assert all(table.put(i % 3, b"%d" % i) == (3 + i, False) for i in range(500))


@pytest.mark.parametrize("table_bytes", [grace.TABLE_BYTES, 2000])  # the second cuts partitions again and again
def test_decisions(spark, table_bytes):
    rows, want = cases.texts(), Counter()
    for text, ids in groups(rows).items():
        known = [d for d in ids if d is not None]
        for d in ids:
            want[d, min(known, default=None), len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    got = grace.decisions(cases.documents(spark), table_bytes=table_bytes).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups(rows)) and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert grace.decisions(cases.documents(spark, [])).count() == 0


def test_hot_content_and_small_tables(spark, monkeypatch):
    rows = [(i, "the same text for a third of all" if i % 3 else f"text {i}") for i in range(600)]
    got = grace.decisions(cases.documents(spark, rows), table_bytes=3000).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id % 3} == {(1, 400)} and len(got) == 600


def test_deduplicated_keeps_rows_whole(spark):
    docs = stored(cases.documents(spark), "docs")
    left = grace.deduplicated(docs)
    assert left.columns == docs.columns and left.exceptAll(docs).count() == 0
    assert left.count() == len(groups(cases.texts()))


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (2, 50)])
def test_components(spark, k, percent):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in fsjoin.components(cases.documents(spark), shingle=k, percent=percent).collect()), key=repr)
    assert got == cases.components(cases.texts(), k, percent)


def test_no_documents(spark):
    assert fsjoin.components(cases.documents(spark, [])).count() == 0
    assert fsjoin.components(cases.documents(spark, [(1, None), (2, " ")])).where("component_id = doc_id AND n_shingles = 0").count() == 2


def test_family_of_borderline_copies(spark, monkeypatch):
    """Many copies of one text with one to five changes each: some link, some only through others, some not at all."""
    rng, base, rows = random.Random(3), cases.prose(9, 160).split(), []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(len(words))] = f"new{rng.randint(0, 10**6)}"
        rows.append((i * 7, " ".join(words)))
    rows += [(5000 + i, cases.prose(50 + i % 20, 60) + (" x" if i % 3 == 0 else "")) for i in range(60)]
    want = cases.components(rows, 4, 85)
    assert 3 < len({c for _, _, c in want}) < 200
    got = fsjoin.components(cases.documents(spark, rows), shingle=4, percent=85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want
    # Every n-gram of the family counts as frequent, tasks hand on often, fragments are many: the same result.
    monkeypatch.setattr(fsjoin, "LEAST", 3)
    monkeypatch.setattr(fsjoin, "GATHER", 2000)
    monkeypatch.setattr(fsjoin, "FRAGMENT", 1000)
    got = fsjoin.components(cases.documents(spark, rows), shingle=4, percent=85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want


def test_one_of_each(spark):
    docs = stored(cases.documents(spark), "docs")
    left = fsjoin.one_of_each(docs)
    assert left.columns == docs.columns and left.exceptAll(docs).count() == 0
    want = {(d, c) for d, n, c in cases.components(cases.texts(), 5, 80)}
    found = Counter(r.doc_id for r in left.collect())
    assert {d for d in found if d is not None} == {c for _, c in want if c is not None}
    assert found[40] == found[41] == found[42] == 1


def test_reachable(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    pairs = [(a, b) for a, b in pairs if a != b]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = fsjoin.reachable(stored(spark.createDataFrame(pairs, "a long, b long"), "pairs")).collect()
    assert {r.node: r.root for r in got} == {x: root(x) for x in parent}


def _fragment_tables(flushes, fragments):
    """What ``_counted`` is given for each fragment: (classes, values, owner) of some flushes."""
    held = {}
    for number, (classes, values, owner) in enumerate(flushes):
        for fragment, *columns in fsjoin._dealt(values, owner, classes, fragments):
            held.setdefault(fragment, []).append(dict(zip(fsjoin._names(fsjoin._CUT), (fragment, number, *columns, None))))
    return [pa.Table.from_pylist(rows, schema=fsjoin._schema(fsjoin._CUT)) for rows in held.values()]


@pytest.mark.parametrize("ids", [(7, 7 + (1 << 32)), (-1, 0xFFFFFFFF), (5, 5 - (1 << 63))])
def test_classes_that_agree_in_their_low_bits_stay_apart(ids):
    """N-grams that only two such classes share come back to both, whether they are in one flush or in two."""
    rng = np.random.default_rng(2)
    common, only = rng.integers(0, 2**63, 23).astype(np.uint64), rng.integers(0, 2**63, 5).astype(np.uint64)
    classes = np.array(ids, np.int64)
    both = (classes, np.concatenate([common, common, only]), np.repeat([0, 1], [23, 28]))
    apart = [(classes[:1], common, np.zeros(23, np.int64)), (classes[1:], np.concatenate([common, only]), np.zeros(28, np.int64))]
    for flushes in ([both], apart):
        back = [r for t in _fragment_tables(flushes, 8) for r in fsjoin._counted(t).to_pylist()]
        assert sum(len(r["index"]) // 2 for r in back) == 46
        assert {c for r in back for c in np.frombuffer(r["counts"], np.uint16).tolist()} == {2}


def test_a_fragment_is_sent_the_classes_that_it_holds_only():
    """At most ten bytes for an n-gram, and for a class in a fragment, however many of both there are."""
    rng = np.random.default_rng(3)

    def sent(classes, fragments):
        owner = np.repeat(np.arange(classes), 40)
        rows = fsjoin._dealt(rng.integers(0, 2**63, len(owner)).astype(np.uint64), owner, rng.integers(0, 2**62, classes), fragments)
        for _, owners, tags, index, low, _ in rows:
            places = np.frombuffer(owners, np.uint16)[np.frombuffer(index, np.uint16)]
            assert len(tags) == 4 * len(owners) and (np.diff(places.astype(int)) >= 0).all() and len(low) == 2 * len(index)
        return sum(len(r[1]) + len(r[2]) for r in rows)

    for classes, fragments in ((100, 64), (1000, 640), (5000, 3200)):
        assert sent(classes, fragments) <= 10 * 40 * classes
    assert sent(1000, 8) <= 10 * 8 * 1000
