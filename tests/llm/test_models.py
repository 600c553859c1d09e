"""Piecewise hashes, nearest examples and the factorisation machine against plain versions and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskflow.llm import catalog, ctph, fm, toxicity

from . import cases


def plain_fingerprint(text: str) -> str:
    """The same rule byte by byte."""
    data, window, values, sums, total = text.encode(), [0] * 7, [], [0], 0
    for c in data:
        window = window[1:] + [c]
        shifted = 0
        for x in window:
            shifted = (shifted << 5 & 0xFFFFFFFF) ^ x
        value = (sum(window) + sum((j + 1) * x for j, x in enumerate(window)) + shifted & 0xFFFFFFFF) + 1
        values.append(value)
        mixed = value * 0x9E3779B97F4A7C15 % 2**64
        total = (total + (mixed ^ mixed >> 32)) % 2**64
        sums.append(total)
    k = 0
    while sum(v % (3 << k) == 0 for v in values) > 63:
        k += 1
    out = [str(3 << k)]
    for size in (3 << k, 6 << k, 12 << k):
        ends = [i + 1 for i, v in enumerate(values) if v % size == 0]
        ends += [len(data)] if data and (not ends or ends[-1] != len(data)) else []
        chars, at = "", 0
        for e in ends:
            x = (sums[e] - sums[at]) % 2**64
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
            x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
            chars += chr(ctph.ALPHABET[(x ^ x >> 31) >> 58])
            at = e
        out.append(chars)
    return ":".join(out)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(last[j - 1] if x == y else min(last[j], row[j - 1]) + 1)
    return row[-1]


def test_fingerprints_byte_by_byte(monkeypatch):
    found = [t or "" for _, t in cases.texts()] + ["", "a", "zz" * 500]
    want = [plain_fingerprint(t) for t in found]
    assert ctph.fingerprints(found) == want
    monkeypatch.setattr(ctph, "AT_ONCE", 100)  # long texts in many parts
    assert ctph.fingerprints(found) == want


def test_likeness_is_the_edit_distance():
    rng = random.Random(1)
    make = lambda n: "".join(rng.choice("ABCDE+/") for _ in range(n))
    for _ in range(200):
        a, b = make(rng.randint(8, 64)), make(rng.randint(8, 64))
        got, = ctph.likeness([(f"3:{a}::", f"3:{b}::")])
        assert got in (0.0, pytest.approx(1 - distance(a, b) / (len(a) + len(b))))
        assert (got == 0) == (not ctph._share_run(a, b))
    assert ctph.likeness([("3:AAAAAAAAAA:B:C", "12:AAAAAAAAAA:B:C"), ("3:x:y:AAAAAAAAA", "12:AAAAAAAAA:q:r"), ("3:::", "3:::")]) == [0.0, 1.0, 1.0]


def test_neighbours(spark):
    rows = [r for r in cases.texts()]
    got = ctph.compare_neighbours(cases.documents(spark)).collect()
    assert len(got) == len(rows)
    ids = sorted({d for d, _ in rows if d is not None and sum(x == d for x, _ in rows) == 1})
    text, by = dict(rows), {r.doc_id: r for r in got}
    checked = 0
    for a, b in zip(ids, ids[1:]):
        if any(a < d < b for d, _ in rows if d is not None):
            continue
        t, n, r = text[a] or "", text[b] or "", by[a]
        half = len(t) // 2
        new = t[:len(t) - half] + n[:half]
        marks = ctph.fingerprints([t, new, n])
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(new.encode()).hexdigest(), marks[0], marks[1])
        assert (r.near_edited, r.near_next) == tuple(ctph.likeness([(marks[0], marks[1]), (marks[0], marks[2])]))
        checked += 1
    assert checked > 20
    last = by[2**61]  # what follows the last is the first: a row without id
    t, n = text[2**61], {r.fingerprint: r for r in got if r.doc_id is None}
    assert last.edited_sha256 in {hashlib.sha256((t[:len(t) - len(t) // 2] + x[:len(t) // 2]).encode()).hexdigest() for x in ("", "no id here")} and len(n) == 2
    assert ctph.compare_neighbours(cases.documents(spark, [])).count() == 0
    one = ctph.compare_neighbours(cases.documents(spark, [(3, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_pairs_in_linear_time():
    rng = np.random.default_rng(2)
    m = fm.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    sizes = [3, 1, 7]
    index, value = np.concatenate([rng.choice(50, n, replace=False) for n in sizes]), rng.normal(size=sum(sizes))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    for (a, b), got in zip(zip(bounds, bounds[1:]), m.margin(index, value, bounds)):
        i, x = index[a:b], value[a:b]
        want = 0.3 + (m.w[i] * x).sum() + sum(m.v[i[p]] @ m.v[i[q]] * x[p] * x[q] for p in range(b - a) for q in range(p))
        assert got == pytest.approx(want)


def test_index_is_exact(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    n, terms = 200, 40
    dense = np.where(rng.random((n, terms)) < 0.15, rng.integers(1, 5, (n, terms)), 0)
    dense[50:60] = dense[10]  # ties
    index = toxicity.Index(toxicity.Terms(np.arange(terms, dtype=np.uint64)), rng.random(terms) + 0.1, np.arange(n), rng.integers(0, 2, n), 7)
    owner, term = np.nonzero(dense)
    index.build(owner, term, dense[owner, term])
    weight = np.where(dense > 0, (1 + np.log(np.maximum(dense, 1))) * index.idf, 0)
    unit = weight / np.maximum(np.linalg.norm(weight, axis=1), 1e-12)[:, None]
    for i in range(n):
        t = np.flatnonzero(unit[i])
        cosine = unit @ unit[i]
        want = [j for j in sorted(range(n), key=lambda j: (-round(cosine[j], 12), j)) if cosine[j] > 0 and j != i][:7]
        got, near = index.nearest(t, unit[i][t], without=i)
        assert got.tolist() == want and near == pytest.approx(np.minimum(cosine[want], 1))


def brute_force_neighbours(rows, labels, size=0):
    """For each text all (cosine, id) of examples with a common word, over all words of both (of their passages of ``size`` words)."""
    words = [re.findall(rb"[a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) for _, t in rows]
    examples = sorted((d, i) for i, (d, _) in enumerate(rows) if d in labels and zlib.crc32(str(d).encode()) % 5)
    df, held = Counter(w for b in words for w in set(b)), Counter(w for _, i in examples for w in set(words[i]))
    toxic, share = Counter(w for d, i in examples if labels[d] for w in set(words[i])), sum(labels[d] for d, _ in examples) / len(examples)

    def speaks(w, own):
        a, n = (toxic[w], held[w]) if own is None else (toxic[w] - own, held[w] - 1)
        odds = math.log((a + toxicity.SMOOTH * share) / (n - a + toxicity.SMOOTH * (1 - share))) - math.log(share / (1 - share))
        return round(max(0, odds) * 2**20) if held[w] else 0

    def vector(i, own=None):
        part = words[i]
        if size and len(part) > size:
            said = [speaks(w, own) for w in part]
            part = max((sum(said[j:j + size]), -j, part[j:j + size]) for j in range(len(part) - size + 1))[2]
        v = {w: (1 + math.log(c)) * math.log(1 + len(rows) / (df[w] if held[w] else 1)) for w, c in Counter(part).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    of, out = {i: vector(i, labels[d]) for d, i in examples}, []
    for i in range(len(rows)):
        v = vector(i)
        near = [(sum(x * of[e].get(w, 0) for w, x in v.items()), d) for d, e in examples]
        out.append(sorted(((c, d) for c, d in near if c > 0), key=lambda x: (-round(x[0], 10), x[1])))
    return out


@pytest.mark.parametrize("size", [0, 12])
def test_neighbours_over_all_words(spark, monkeypatch, size):
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    monkeypatch.setattr(toxicity, "AT_ONCE", 100)
    rows = [(d, t) for d, t in {d: (d, t) for d, t in cases.texts() if d is not None}.values()]
    rows += [(1000 + i, cases.prose(i, 30 + i % 50) + (" clown" if i % 4 == 0 else "") + f" own{'abcdefghij'[i % 10] * (i % 7 + 1)}") for i in range(150)]
    rows += [(2000 + i, "quite unlike words stand here alone zz" + "qwxv"[i % 4] * (i + 1)) for i in range(4)]  # words of no example
    rows += [(3000 + i, rows[40][1]) for i in range(30)]  # equal examples
    labels = {d: int("clown" in (t or "")) for d, t in rows if not 2000 <= d < 3000}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cases.documents(spark, [])  # ships the package
    made = spark.createDataFrame([(d, 1, y) for d, y in labels.items()], cases.LABELS)
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, made, passage=size), evidence=True).collect()}
    searched = 0
    for (d, _), want in zip(rows, brute_force_neighbours(rows, labels, size)):
        top = want[:toxicity.NEIGHBOURS]
        assert got[d].cosines == pytest.approx([c for c, _ in top], abs=1e-9), d
        assert got[d].neighbours == [e for _, e in top], d
        searched += bool(top)
    assert searched > 0.9 * len(rows)


def test_most_blocks_are_not_scored(spark):
    sf = "/root/testdata/sf0.01"
    cases.documents(spark, [])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    index = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    index._prepare()
    index.score([r.text or "" for r in docs.select("text").collect()])
    assert index._blocks > 30 and 0 < index.scored_blocks < 0.8 * index.all_blocks, (index.scored_blocks, index.all_blocks)


def brute_force_heed(said, size):
    """For each word the most that a window over it says, as a share of the most that any window says."""
    sums = [sum(said[j:j + size]) for j in range(len(said) - size + 1)]
    return [(max(sums[max(0, i - size + 1):i + 1]) + 1) / (max(sums) + 1) for i in range(len(said))] if len(said) > size else [1.0] * len(said)


@pytest.mark.parametrize("size", [1, 3, 16])
def test_every_word_is_heeded(size):
    rng = np.random.default_rng(5)
    sizes = [0, 1, size, size + 1, 40, 0, 100, 7]
    said = [rng.integers(0, 50, n) * (rng.random(n) < 0.3) for n in sizes] + [np.zeros(30, np.int64)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in said])])
    got = toxicity.attention(bounds, np.concatenate(said), size)
    assert got.tolist() == pytest.approx([x for s in said for x in brute_force_heed(s.tolist(), size)])
    assert len(got) == bounds[-1] and got.min() > 0


def test_searches_agree():
    rng = np.random.default_rng(6)
    n, terms = 400, 60
    dense = np.where(rng.random((n, terms)) < np.linspace(0.005, 0.3, terms), rng.integers(1, 4, (n, terms)), 0)
    dense[50:80] = dense[10]  # ties
    index = toxicity.Index(toxicity.Terms(np.arange(terms, dtype=np.uint64)), rng.random(terms) + 0.1, np.arange(n), rng.integers(0, 2, n), 7)
    owner, term = np.nonzero(dense)
    index.build(owner, term, dense[owner, term])
    query = np.where(rng.random((50, terms)) < 0.5, rng.random((50, terms)), 0)
    query[3] = 0
    query /= np.maximum(np.linalg.norm(query, axis=1), 1e-12)[:, None]
    owner, term = np.nonzero(query)
    for k in (1, 7, 390):
        pairs = list(zip(index.search(owner, term, query[owner, term], 50, k), index.search_all(owner, term, query[owner, term], 50, k)))
        assert len(pairs) == 50 and all(a[0].tolist() == b[0].tolist() and a[1] == pytest.approx(b[1]) for a, b in pairs)
        assert len(pairs[3][0][0]) == 0 and len(pairs[0][0][0]) > 0


def test_other_windows_than_the_best_count(spark):
    """Two texts whose most telling passage is the same: what one of them has in its other windows has a vote as well."""
    rng = random.Random(8)
    mixed, plain = ["m" + a + b for a in "abcd" for b in "efgh"], ["p" + a + b for a in "abcdefgh" for b in "abcdefgh"]
    insult = ["utter", "clown", *plain[::5], "pzz"]
    rows, labels = [], []

    def add(words, toxic):
        labels.append((len(rows), 1, int(toxic)))
        rows.append((len(rows), " ".join(words)))

    for i in range(1100):
        if i % 11 == 0:
            add(insult, True)
        elif i % 11 < 4:
            add(rng.sample(mixed, 12) + rng.choices(plain, k=4), rng.random() < 0.4)
        else:
            add(rng.choices(plain, k=16), False)
    for i in range(200):  # long ones, so that the view of all windows has votes to learn from
        add(rng.sample(mixed, 12) + rng.choices(plain, k=40) + (insult if i % 2 else []), i % 2)
    filler = " ".join(rng.choices(plain, k=60))
    rows += [(5000, f"{' '.join(mixed)} {filler} {filler}"), (5001, f"{' '.join(mixed)} {filler} clown {filler}")]
    docs = cases.documents(spark, rows)
    index = toxicity.fit(docs, spark.createDataFrame(labels, cases.LABELS))
    texts = [t for _, t in rows[-2:]]
    one, two = index.score(texts)
    assert one[1].tolist() == two[1].tolist() and one[2] == pytest.approx(two[2])  # the passage's neighbours
    spoken = index._spoken(texts)
    owner, term, weight = index.widely(*spoken)
    for i, t in enumerate(texts):  # every word that examples have
        assert sorted(term[owner == i].tolist()) == np.flatnonzero(np.isin(index.terms.hashes, toxicity._words([t])[0])).tolist()
    near = index.search_all(owner, term, weight, 2, index.k)
    assert near[0][1] != pytest.approx(near[1][1])
    votes = index.wide_votes(*spoken)
    assert votes == [index.vote(*n) for n in near]
    label = dict(zip(index.ids.tolist(), index.labels.tolist()))
    for (score, near, cosines, _), vote in zip((one, two), votes):
        weight = 1 / (1.02 - cosines)
        passage = (weight * [label[d] for d in near.tolist()]).sum() / weight.sum()
        assert score == pytest.approx(max(index.probability(passage), index.probability(vote, index.wide_steps)))


def test_repeated_rows_keep_the_bound(spark):
    rows = [(7, "seven")] * 300 + [(8, f"text {i}") for i in range(100)] + [(100 + i, f"other {i % 5}") for i in range(40)]
    labels = spark.createDataFrame([(d, 1, d % 2) for d in {d for d, _ in rows}] + [(7, 1, 1)] * 50, cases.LABELS)
    docs = cases.documents(spark, rows)
    free = {d for d, _ in rows if zlib.crc32(str(d).encode()) % 5}
    assert {7, 8} <= free
    for limit in (10, len(free), 60, 1000):
        got = fm.labelled(docs, labels, "toxic", ["text", "n_chars"], limit).collect()
        assert len(got) == len({(r.d_id, r.text, r.y) for r in got}) == min(limit, len(free) + 99)
        assert len({r.d_id for r in got}) == min(limit, len(free)) and all((r.d_id, r.text) in set(rows) and r.y == r.d_id % 2 for r in got)
    assert len(toxicity.fit(docs, labels, examples=20).ids) == 20


def test_all_examples_calibrate(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CALIBRATED", 40, raising=False)  # there was such a bound
    rows = [(i, cases.prose(i, 30) + (" clown" * (1 + i % 3) if i % 4 == 0 and i > 100 else "")) for i in range(300)]
    labels = spark.createDataFrame([(d, 1, int("clown" in t or d % 9 == 0)) for d, t in rows], cases.LABELS)
    index = toxicity.fit(cases.documents(spark, rows), labels)
    votes = index.own_votes(np.arange(len(index.ids)))
    assert len(votes) > 200
    at, p = toxicity.isotonic(np.array([v for _, v in votes]), index.labels[[i for i, _ in votes]].astype(float))
    assert index.steps[0].tolist() == at.tolist() and index.steps[1].tolist() == p.tolist()


def test_isotonic():
    x, y = np.array([0, 0.1, 0.2, 0.3, 0.4, 0.4]), np.array([0.0, 1, 0, 1, 1, 1])
    at, p = toxicity.isotonic(x, y)
    assert list(p) == sorted(p) and at[0] == 0 and p[-1] > 0.5 > p[0]


@pytest.mark.parametrize("name, label, least", [("op5_nearest_examples", "toxic", 0.8), ("op10_factorisation_machine", "quality", 0.95)])
def test_held_out_labels(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    rows = catalog.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    pos, neg = [r.score for r in rows if r[label]], [r.score for r in rows if not r[label]]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc >= least


def test_scores_of_odd_rows(spark):
    docs, rows = cases.documents(spark), cases.texts()
    labels = spark.createDataFrame([(d, i % 2, 1 if "stupid" in (t or "") or i % 5 == 0 else 0) for i, (d, t) in enumerate(rows)] + [(None, 1, 1), (44, None, None), (-99, 1, 1)], cases.LABELS)
    for module, label in ((fm, "quality"), (toxicity, "toxic")):
        model = module.fit(docs, labels, label)
        scored = module.score(docs, model, name="score")
        assert sorted(scored.columns) == sorted(docs.columns) and scored.count() == len(rows)
        assert all(0 <= r.score <= 1 for r in scored.collect())
        assert len({r.score for r in scored.where("text = 'seven'").collect()}) == 1
        assert module.score(cases.documents(spark, []), model).count() == 0
        bare = module.fit(docs, labels.limit(0), label)
        assert {r.score for r in module.score(docs, bare).collect()} == {0.5}
        kind = module.fit(docs, spark.createDataFrame([(d, 1, 1) for d in (43, 44, 45, 46, 48, 49)], cases.LABELS), label)
        found = {r.score for r in module.score(docs, kind).collect()}
        assert len(found) == 1 and found.pop() > 0.5
