"""N-gram Jaccard join by vertical partitioning.

All n-grams of the corpus have one global order: rare ones first, by the number of different sets that hold them, then
by hash. The order is cut into fragments (by hash; n-grams in more than 1/500 of the documents, a bounded list, stand at
its end and need no counting). Each document's set is cut accordingly, and fragments are worked on apart:

1. Equal sets are one class; one member stands for it from here on.
2. In each fragment the n-grams are counted. Those of one class only can't overlap with anything and are dropped; what
   is left goes back to the class, with counts. So the order is known and the class knows its prefix: as
   many of the first n-grams as two linked sets can't both lack. Classes whose prefix is unique have no link.
3. Classes that share a prefix n-gram are candidates. First each is held against the group's purest member (the
   one with the fewest unique n-grams), which links most of a family of near copies without making pairs of all of it. Then
   come all pairs of a group whose members aren't connected yet. Pairs pass only if their sizes, their numbers of shared
   n-grams and a bitmap of 512 parities (no two sets differ in fewer n-grams than their bitmaps in bits) allow a link.
4. For each pair the partial overlaps are counted fragment by fragment and summed; the sum decides.

The result is one row per document with the least id reachable by links; copies are never expanded into pairs. Documents link when
100 * intersection >= percent * union. N-grams are held as 64-bit hashes (within a fragment as 40 of their bits beside the fragment's own).

Null and empty texts, and texts without words, have empty sets and link with nothing. Null ids are no class's least id unless it has
no other. Repeated rows are one class. An empty table gives no rows. Other columns are kept by ``one_of_each`` and left
out by ``components``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.tables import fresh, slices, stored, texts_of
from riskflow.llm.words import shingle_sets

#: N-grams of a fragment, n-grams a task gathers before it hands its fragments on, parts an overlap is counted in.
FRAGMENT, GATHER, PARTS = 1_000_000, 1_000_000, 8
#: N-grams in more than this share of a task's documents (but 16 at least) are counted for the list of frequent ones.
FREQUENT, LEAST = 1 / 500, 16
BITS = 8  # words of 64 parities


def _class_id(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - 2**63


def _keys(hashes: np.ndarray, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, 40 further bits) of n-gram hashes."""
    return (hashes & np.uint64(fragments - 1)).astype(np.uint32), (hashes >> np.uint64(24))


def _profile(docs: DataFrame, id_col: str, text_col: str, row_col: str | None, shingle: int) -> DataFrame:
    """Written: a row for each document (row, doc_id, n, class) and, with ``n`` null, frequent n-grams (class: hash, row: documents)."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (F.col(row_col) if row_col else F.lit(0)).cast("long").alias("row"))

    def scan(batches):
        kinds = ("row", "doc_id", "n", "class")
        held, seen, total = [], 0, 0

        def frequent(parts, least):
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            return values[counts >= least], counts[counts >= least]

        for batch in slices(batches):
            sets = shingle_sets(texts_of(batch.column(1)), shingle)
            n = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(n, pa.int64()), pa.array([_class_id(s) if len(s) else None for s in sets], pa.int64())], names=kinds)
            # Copies of one set count once here, else a family of copies would make all its n-grams frequent.
            new = {_class_id(s): s for s in sets if len(s)}
            held += new.values()
            seen, total = seen + len(new), total + sum(map(len, new.values()))
            if total >= GATHER:
                values, counts = frequent(held, max(LEAST, seen * FREQUENT))
                yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64()), pa.nulls(len(values), pa.int64()), pa.nulls(len(values), pa.int64()), pa.array(values.view(np.int64), pa.int64())], names=kinds)
                held, seen, total = [], 0, 0
        if held:
            values, counts = frequent(held, max(LEAST, seen * FREQUENT))
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64()), pa.nulls(len(values), pa.int64()), pa.nulls(len(values), pa.int64()), pa.array(values.view(np.int64), pa.int64())], names=kinds)

    return stored(own.mapInArrow(scan, "row long, doc_id long, n long, class long"), "ngram_profile")


_CUT = "fragment int, flush long, owners binary, tags binary, index binary, low binary, high binary, about binary"
_BACK = "flush long, index binary, low binary, high binary, fragment int, counts binary, about binary"
_KEPT = "class long, n long, shared long, bits array<long>, prefix array<long>, parts array<array<long>>"


def _dealt(values: np.ndarray, owner: np.ndarray, classes: np.ndarray, fragments: int) -> list[tuple]:
    """(fragment, owners, tags, index, low, high) of a flush's n-grams: only the classes that have some in a fragment send their ids (tags) there.

    ``owners`` are those classes' places in the flush, ``index`` each n-gram's place among them. ``owner`` must ascend.
    """
    part, key = _keys(values, fragments)
    order = np.argsort(part, kind="stable")
    part, key, index = part[order], key[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.empty(0, np.int64)
    out = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
        new = np.concatenate([[True], index[a + 1:b] != index[a:b - 1]])  # a class's n-grams lie together
        owners = index[a:b][new]
        out.append((int(part[a]), owners.astype(np.uint16).tobytes(), classes[owners].tobytes(), (np.cumsum(new) - 1).astype(np.uint16).tobytes(),
                    (key[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), ((key[a:b] >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8).tobytes()))
    return out


def _counted(part: pa.Table) -> pa.Table:
    """In a fragment: the classes that hold each n-gram; n-grams of a single one aren't sent back."""
    out, keys, tags, rows = [], [], [], []
    for r in part.to_pylist():
        if r["about"] is not None:
            out.append((r["flush"], None, None, None, None, None, r["about"]))
            continue
        index = np.frombuffer(r["index"], np.uint16)
        keys.append(np.frombuffer(r["low"], np.uint32).astype(np.uint64) | np.frombuffer(r["high"], np.uint8).astype(np.uint64) << np.uint64(32))
        tags.append(np.frombuffer(r["tags"], np.int64)[index])
        rows.append((r["flush"], np.frombuffer(r["owners"], np.uint16)[index], r["fragment"]))
    if keys:
        key, tag = np.concatenate(keys), np.concatenate(tags)
        order = np.lexsort((tag, key))
        k, t = key[order], tag[order]
        new_key = np.concatenate([[True], k[1:] != k[:-1]])
        new = new_key | np.concatenate([[True], t[1:] != t[:-1]])
        group = np.cumsum(new_key) - 1
        counts = np.empty(len(key), np.int64)
        counts[order] = np.bincount(group, new)[group]
        at = 0
        for (flush, index, fragment), own in zip(rows, keys):
            n = counts[at:at + len(own)]
            more = n >= 2
            at += len(own)
            if more.any():
                out.append((flush, index[more].tobytes(), (own[more] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), (own[more] >> np.uint64(32)).astype(np.uint8).tobytes(),
                            fragment, np.minimum(n[more], 65_535).astype(np.uint16).tobytes(), None))
    return pa.Table.from_pylist([dict(zip(_names(_BACK), r)) for r in out], schema=_schema(_BACK))


def _kept(docs: DataFrame, text_col: str, shingle: int, percent: int, fragments: int, common: np.ndarray) -> DataFrame:
    """Classes whose prefix holds an n-gram of another class: size, shared n-grams (all, by part, and of the prefix), parities."""
    spark = docs.sparkSession
    wide = spark.sparkContext.broadcast(common)  # in order; at most the frequent n-grams of 1/FREQUENT documents

    def cut(batches):
        """Hand on each fragment's share of the sets; a flush is a group of classes that come back together."""
        from pyspark import TaskContext

        base, flush, seen = TaskContext.get().partitionId() << 24, 0, set()
        frequent, maybe = np.sort(wide.value), np.zeros(1 << 16, bool)
        maybe[(frequent & np.uint64(0xFFFF)).astype(np.int64)] = True
        sets: list[np.ndarray] = []

        def hand_on():
            n = np.array([len(s) for s in sets])
            values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
            often = maybe[(values & np.uint64(0xFFFF)).astype(np.int64)]
            if often.any():
                at = np.flatnonzero(often)
                place = np.minimum(np.searchsorted(frequent, values[at]), max(0, len(frequent) - 1))
                often[at] = frequent[place] == values[at]
            classes = np.array([_class_id(s) for s in sets], np.int64)
            parity = np.zeros((len(sets), BITS * 64), np.uint8)
            np.bitwise_xor.at(parity, (owner, (values >> np.uint64(55)).astype(np.int64)), 1)
            bits = np.packbits(parity, axis=1, bitorder="little")
            about = b"".join([np.int64(len(sets)).tobytes(), classes.tobytes(), n.astype(np.int64).tobytes(), bits.tobytes(),
                              owner[often].astype(np.uint32).tobytes(), values[often].tobytes()])
            rows = [(fragment, base + flush, *held, None) for fragment, *held in _dealt(values[~often], owner[~often], classes, fragments)]
            rows.append((flush % fragments, base + flush, None, None, None, None, None, about))
            for at in range(0, len(rows), 32):
                yield pa.RecordBatch.from_pylist([dict(zip(_names(_CUT), r)) for r in rows[at:at + 32]], schema=_schema(_CUT))

        total = 0
        for batch in slices(batches):
            for s in shingle_sets(texts_of(batch.column(0)), shingle):
                if len(s) and (c := _class_id(s)) not in seen:
                    seen.add(c)
                    sets.append(s)
                    total += len(s)
                    if total >= GATHER or len(sets) >= 65_000:
                        yield from hand_on()
                        sets.clear()
                        total, flush = 0, flush + 1
        if sets:
            yield from hand_on()

    def keep(part: pa.Table) -> pa.Table:
        """Back at the classes of a flush: their prefixes in the global order."""
        rows = part.to_pylist()
        about = next(r["about"] for r in rows if r["about"] is not None)
        m = int(np.frombuffer(about[:8], np.int64)[0])
        at = 8
        classes, at = np.frombuffer(about[at:at + 8 * m], np.int64), at + 8 * m
        n, at = np.frombuffer(about[at:at + 8 * m], np.int64), at + 8 * m
        bits, at = np.frombuffer(about[at:at + 8 * BITS * m], np.int64).reshape(m, BITS), at + 8 * BITS * m
        often = (len(about) - at) // 12
        often_index, often_value = np.frombuffer(about[at:at + 4 * often], np.uint32), np.frombuffer(about[at + 4 * often:], np.uint64)
        shared = [r for r in rows if r["about"] is None]
        index = np.concatenate([*(np.frombuffer(r["index"], np.uint16) for r in shared), often_index]).astype(np.int64)
        # An n-gram's name: its fragment and 40 bits; frequent ones in the same form.
        often_part, often_key = _keys(often_value, fragments)
        name = lambda p, k: (np.asarray(k, np.uint64) & np.uint64((1 << 40) - 1)) << np.uint64(23) | np.asarray(p, np.uint64)
        key = np.concatenate([*(name(r["fragment"], np.frombuffer(r["low"], np.uint32).astype(np.uint64) | np.frombuffer(r["high"], np.uint8).astype(np.uint64) << np.uint64(32)) for r in shared),
                              name(often_part, often_key)]).astype(np.int64)
        rank_of = np.argsort(wide.value, kind="stable")
        rank = rank_of[np.searchsorted(wide.value, often_value, sorter=rank_of)] if often else np.empty(0, np.int64)
        counted = np.concatenate([*(np.frombuffer(r["counts"], np.uint16).astype(np.int64) for r in shared), 65_536 + rank])
        order = np.lexsort((key, counted, index))
        index, key = index[order], key[order]
        some = np.bincount(index, minlength=m)
        unique = n - some
        prefix = n - -(-percent * n // 100) + 1
        first = np.minimum(some, prefix - unique)
        bounds = np.concatenate([[0], np.cumsum(some)])
        out = []
        for i in np.flatnonzero((first > 0) & (100 * some >= percent * n)).tolist():
            own = key[bounds[i]:bounds[i + 1]]
            cuts = own & (PARTS - 1)
            out.append((int(classes[i]), int(n[i]), int(some[i]), bits[i].tolist(), own[:first[i]].tolist(), [own[cuts == j].tolist() for j in range(PARTS)]))
        return pa.Table.from_pylist([dict(zip(_names(_KEPT), r)) for r in out], schema=_schema(_KEPT))

    cuts = docs.select(F.col(text_col)).mapInArrow(cut, _CUT)
    back = cuts.groupBy("fragment").applyInArrow(_counted, _BACK)
    kept = back.groupBy("flush").applyInArrow(keep, _KEPT)
    # A class that several tasks hold has come back several times, with the same values.
    return stored(kept, "ngram_classes")


def _names(ddl: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in ddl.split(", ")]


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<array<long>>": pa.list_(pa.list_(pa.int64()))}
    return pa.schema([(c.strip().split(" ")[0], kinds[c.strip().split(" ")[1]]) for c in ddl.split(", ")])


def _possible(percent: int) -> Column:
    """Whether sizes, shared n-grams and parities of the classes l and r allow a link."""
    both = F.col("l.n") + F.col("r.n")
    differ = reduce(lambda x, y: x + y, (F.bit_count(F.col("l.bits")[i].bitwiseXOR(F.col("r.bits")[i])) for i in range(BITS)))
    return ((100 + percent) * F.least("l.shared", "r.shared") >= percent * both) & (100 * F.least("l.n", "r.n") >= percent * F.greatest("l.n", "r.n")) & \
        ((100 - percent) * both >= (100 + percent) * differ)


def _linked(pairs: DataFrame, kept: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose partial overlaps, counted part by part, sum up to a link. ``pairs`` is a written table."""
    parts = kept.select("class", "n", F.posexplode("parts").alias("part", "grams"))
    a, b = parts.select(F.col("class").alias("a"), F.col("n").alias("n_a"), "part", F.col("grams").alias("g_a")), parts.select(
        F.col("class").alias("b"), F.col("n").alias("n_b"), "part", F.col("grams").alias("g_b"))
    partial = pairs.join(a, "a").join(b, ["b", "part"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("g_a", "g_b")).cast("long").alias("o"))
    whole = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("o").alias("o"))
    return stored(whole.where((100 + percent) * F.col("o") >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "ngram_links")


def reachable(links: DataFrame) -> DataFrame:
    """(node, root): the least node of its component, for all nodes of the written table ``links`` (a, b).

    Labels pass along links and are shortened by following the label's own label; each round is written.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    label = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("m"))
        met = label.join(near, F.col("node") == F.col("a")).select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        up = label.select(F.col("node").alias("via"), F.col("root").alias("further"))
        new = stored(met.join(up, F.col("root") == F.col("via"), "left").select("node", "old", F.least("root", F.coalesce("further", "root")).alias("root")), "labels")
        if new.where("old <> root").isEmpty():
            return new.select("node", "root")
        label = new.select("node", "root")


def class_links(docs: DataFrame, text_col: str, shingle: int, percent: int, profile: DataFrame) -> DataFrame:
    """Links between classes that connect whatever is connected (a written table a, b)."""
    spark = docs.sparkSession
    found = profile.where("n IS NOT NULL").agg(F.sum("n"), F.count(F.lit(1))).first()
    fragments = 1 << max(3, int(found[0] or 0) // FRAGMENT).bit_length()
    # Counts come only from tasks where the n-gram is frequent; any list gives right results, this one is short.
    often = profile.where("n IS NULL").groupBy("class").agg(F.sum("row").alias("c")).where(F.col("c") >= max(LEAST, (found[1] or 0) * FREQUENT / 4))
    listed = sorted(((r.c, r["class"]) for r in often.collect()), key=lambda x: (x[0], x[1]))
    common = np.array([v for _, v in listed], np.int64).view(np.uint64)
    kept = _kept(docs, text_col, shingle, percent, min(fragments, 1 << 23), common).dropDuplicates(["class"])
    kept = stored(kept, "ngram_kept")
    about = kept.select("class", "n", "shared", "bits")
    prefixes = kept.select(F.explode("prefix").alias("key"), "class", "n", "shared")
    spans = prefixes.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.min_by("class", F.col("n") - F.col("shared") + F.lit(1e-9) * F.col("n")).alias("leader"))
    spans = spans.where(F.col("least") < F.col("most"))
    entries = stored(prefixes.join(spans.select("key", "leader"), "key").select("key", "class", "leader"), "ngram_entries")

    def checked(pairs: DataFrame) -> DataFrame:
        real = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        allowed = real.join(about.alias("l"), F.col("a") == F.col("l.class")).join(about.alias("r"), (F.col("b") == F.col("r.class")) & _possible(percent))
        return _linked(stored(allowed.select("a", "b"), "ngram_pairs"), kept, percent)

    first = checked(entries.where("class <> leader").select(F.col("class").alias("x"), F.col("leader").alias("y")).distinct())
    roots = reachable(first)
    known = entries.join(roots, F.col("class") == F.col("node"), "left").select("key", "class", F.coalesce("root", "class").alias("root"))
    sizes = known.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("key").agg(F.max_by("root", "c").alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("key", "main")
    still = stored(known.join(main, "key").join(about, "class").select("key", "class", "root", "main", "n", "shared", "bits"), "ngram_open")
    # Every pair of unconnected members has one that isn't in its group's largest component.
    l, r = still.where("root <> main").alias("l"), still.alias("r")
    apart = (F.col("l.key") == F.col("r.key")) & (F.col("l.root") != F.col("r.root")) & _possible(percent)
    rest = l.join(r, apart).select(F.col("l.class").alias("x"), F.col("r.class").alias("y"))
    return stored(first.union(checked(rest.distinct())), "ngram_all_links")


def _classes(docs: DataFrame, id_col: str, text_col: str, row_col: str | None, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(documents, roots): the written profile's documents, and the root of each class that has links."""
    profile = _profile(docs, id_col, text_col, row_col, shingle)
    return profile.where("n IS NOT NULL"), reachable(class_links(docs, text_col, shingle, percent, profile))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable by links)."""
    own, roots = _classes(docs, id_col, text_col, None, shingle, percent)
    # Copies are summed up within tasks first; a component has one row per class from there on.
    classes = own.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    rooted = classes.join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.where("copies > 1 OR node IS NOT NULL").join(least, "root").select(F.col("class").alias("c"), "component_id")
    return own.join(named, F.col("class") == F.col("c"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows that stay when of each component only the one with the least id does, with all their columns.

    Documents without words all stay. Of rows that share the least id, one stays.
    """
    row, kept_row = fresh(docs, "row_number", "kept_row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    own, roots = _classes(numbered, id_col, text_col, row, shingle, percent)
    last = F.coalesce("doc_id", F.lit(2**63 - 1))
    classes = own.where("class IS NOT NULL").groupBy("class").agg(F.min(last).alias("least"), F.min_by("row", last).alias("row"))
    rooted = classes.join(roots, F.col("class") == F.col("node"), "left").groupBy(F.coalesce("root", "class").alias("root")).agg(F.min_by("row", "least").alias(kept_row))
    kept = rooted.select(kept_row).union(own.where("class IS NULL").select("row"))
    return numbered.join(kept, F.col(row) == F.col(kept_row), "left_semi").select(*docs.columns)
