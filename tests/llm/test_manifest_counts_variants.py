"""Merkle manifests, token counts and spelling variants against plain versions of their rules."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskflow.llm import merkle, spelling, tokencount
from riskflow.llm.encode import tokenizer_path

from . import cases
from .test_tokens import odd_texts

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """The end of a list of leaves and, for each, its steps (siblings before, behind)."""
    level, steps, above = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for k, at in enumerate(above):
            run, slot = runs[at // 3], at % 3
            steps[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        level, above = [H(*run) for run in runs], [at // 3 for at in above]
    return level[0], steps


def plain_audit(rows):
    """Sorted results for rows (doc_id, source, lang, n_chars, text), where the ids that 3 divides lose their line ends."""
    def leaf(row):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    kept = {s: sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in groups[s]), key=lambda x: x[:3]) for s in order}
    trees = {s: tree([x[2] for x in kept[s]]) for s in order}
    root, above = tree([trees[s][0] for s in order])
    out = []
    for s, rest in zip(order, above):
        for (_, _, own, row), steps in zip(kept[s], trees[s][1]):
            changed = leaf((*row[:4], row[4].replace("\n", ""))) if row[0] is not None and row[0] % 3 == 0 and row[4] is not None else own
            node = changed
            for left, right in [*steps, *rest]:
                node = H(left, node, right)
            out.append((row[0], own, trees[s][0], root, H(*(x for step in [*steps, *rest] for x in step)), node, node == root))
    return sorted(out, key=repr)


def audited(docs):
    text = F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.audit(docs, text, COLUMNS).collect()), key=repr)


def test_manifest(spark):
    docs = cases.documents(spark).withColumn("source", F.expr("case pmod(coalesce(length(text), 0), 5) when 0 then null when 1 then '' when 2 then 'é' when 3 then 'z' else 'hot' end"))
    assert audited(docs) == plain_audit([tuple(r) for r in docs.select(*COLUMNS).collect()])


@pytest.mark.parametrize("sizes", [{"a": 1}, {None: 3, "b": 4}, {"hot": 2300, None: 730, "c": 729, "d": 28, **{f"one{i}": 1 for i in range(40)}}])
def test_manifest_of_many_rows(spark, sizes):
    rows = [(i if i % 7 else i - 1, s, "en", i, f"line\n{i % 50}") for s, n in sizes.items() for i in range(n)]
    rows += [(5, "hot", None, None, "again\nand again")] * (400 if len(sizes) > 3 else 0)  # rows that are alike in all columns
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    found = audited(docs)
    assert found == plain_audit(rows)
    assert len(rows) < 3 or {r[-1] for r in found} == {True, False}


def test_manifest_of_no_rows(spark):
    found = merkle.manifest(cases.documents(spark, []), COLUMNS)
    assert found.root is None and found.proofs.count() == 0 and found.subroots.count() == 0
    assert audited(cases.documents(spark, [])) == []


def test_manifest_needs_one_window_shuffle_a_round(spark, monkeypatch):
    units = spark.range(100).select(F.lit("k").alias("key"), F.col("id").alias("pos"), F.lit(100).cast("long").alias("n"), F.lit("x").alias("digest"))
    plan = merkle._joined(units)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count(" Sort ") <= 1 and "Python" not in plan


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_are_the_librarys(name):
    own, library = tokencount.Counter(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    found = odd_texts() + ["x" * 3000, "the" * 2000 + "ab" * 500, "one\ntwo\r\nthree\tfour", "<|endoftext|>", "a<|startoftext|>b<|endoftext|><|x|>", "é" * 700, "é é ẞ ﬁ"]
    for _ in range(2):  # from empty and from full caches
        for text in found:
            assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_counts_from_small_caches(monkeypatch):
    monkeypatch.setattr(tokencount, "KEPT", 3)
    own, library = tokencount.Counter(tokenizer_path("word_bpe_49k.json")), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for text in [cases.prose(8, 200), cases.prose(9, 200)]:
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(own.word.young) <= 3 and len(own.word.old) <= 3


def test_count_tokens(spark):
    rows = cases.texts() + [(900, "wordy " * 400_000)]
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = []
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 2048))
    found = tokencount.count_tokens(cases.documents(spark, rows))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr) and any(w[3] for w in want)
    assert tokencount.count_tokens(cases.documents(spark, [])).count() == 0


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, letters=7, strike=31):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if strike and i is not None and (h := zlib.crc32(f"{i}:{run}".encode())) % strike == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= letters:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    form = {w: f for w in counts if near[w] and counts[f := min(near[w], key=lambda o: (-counts[o], o))] >= 10 * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items())


def found_variants(docs, **more):
    return sorted((tuple(r) for r in spelling.variants(docs, **more).collect()))


def variant_rows():
    """Words of few letters, so that many are near; chains of forms; long words that differ at one place; letters beyond ASCII."""
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(3, 9))) for _ in range(250)] + ["aaaaaaa" + "a" * i for i in range(6)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(40)]
    long = "".join(rng.choice("abcde") for _ in range(3000))
    texts += [(100 + i, x) for i in range(2) for x in (long, long[:1500] + "z" + long[1500:], long[:-1], "z" + long[1:], "long" + long)]
    texts += [(200, "governmant " * 2), (201, "government " * 25 + "Government, GOVERNMENT"), (202, "governments " * 400), (203, "governmentsx " * 4000), (204, "governmentsà gouvernement\nÀÉÎabcd àéîabcd ÀÉÎabcd ÀÉÎabcé " * 2)]
    texts += [(205, "tiedform " * 2 + "tiedforma " * 20 + "tiedformb " * 20), (206, "straße×÷ " * 3 + "abc" * 3), (None, "nullwords nullwords"), (None, None), (207, ""), (208, "seventh seventh"), (208, "seventh seventi seventi")]
    return texts


@pytest.mark.parametrize("crowd", [20_000, 3])
def test_variants(spark, monkeypatch, crowd):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    rows = variant_rows() + cases.texts()
    docs = cases.documents(spark, rows)
    want = plain_variants(rows)
    assert found_variants(docs, strike=31) == want
    forms = {w[0]: w for w in want}
    assert any(w[1] and w[1] != w[2] for w in want), "no form of a form"
    assert any(w[4] > 5 for w in want) and any(len(w) > 2000 and r[4] for w, r in forms.items())


def test_variants_of_few_words(spark):
    assert found_variants(cases.documents(spark, [])) == []
    assert found_variants(cases.documents(spark, [(1, None), (2, ""), (3, "short words only")])) == []
    assert found_variants(cases.documents(spark, [(1, "lonesome lonesome")])) == [("lonesome", None, "lonesome", 2, 0, None)]
    rows = [(1, "ab ab abc abc b b cab"), (2, "cab")]
    assert found_variants(cases.documents(spark, rows), letters=1) == plain_variants(rows, letters=1, strike=None)
