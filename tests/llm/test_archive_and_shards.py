"""WARC archives with merged indexes; vector bin packing."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from riskflow.llm import binpack, warc
from riskflow.llm.tables import open_input, ship, stored

from . import cases


def pages(spark):
    ship(spark)
    long = "<p>" + "é" * 80 + "</p>"
    rows = [(i, f"http://www.site{i % 7}.org/a/{i % 13}?q={i}", f"<html>{cases.prose(i % 50, 30)}</html>") for i in range(300)]
    rows += [(900, "HTTP://SITE1.org:80/a\nb", long), (901, None, long), (899, "http://[bad", long), (902, "", None), (903, "x", ""), (904, "x", "short"), (905, "x", "short"), (None, "u", long), (None, None, None), (910, "dup", "d" * 120), (910, "dup", "d" * 120)]
    return rows, spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string").repartition(5)


def wanted(rows):
    least = {}
    for p, _, h in rows:
        if len((h or "").encode()) >= 100 and p is not None:
            least[h] = min(least.get(h, p), p)
    out = Counter()
    for p, _, h in rows:
        raw = (h or "").encode()
        first = least.get(h) if len(raw) >= 100 else None
        revisit = first is not None and p != first
        out[p, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    return out


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 6, 9, 16):
        runs = [sorted((f"{rng.randint(0, 60):03d}", f"{j}") for _ in range(rng.randint(0, 30))) for j in range(k)]
        got = list(warc.merged([iter(r) for r in runs]))
        assert got == sorted((x for r in runs for x in r), key=lambda x: (x[0], int(x[1])))


def test_archive(spark):
    rows, table = pages(spark)
    when = F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) % 40)
    blocks = warc.write(warc.captures(table, "page_id", "url", "html", when), archive_bytes=5000, run=20)
    assert blocks.select("run").distinct().count() > 10
    one_pass = warc.merge(blocks, fan_in=3, range_entries=1)
    assert one_pass.select("run").distinct().count() <= 3 and one_pass.agg(F.sum("entries")).first()[0] == len(rows)
    index = stored(warc.histories(one_pass, range_entries=1), "index")
    order = [(r.url_key, r.when) for r in index.orderBy("part", "place").collect()]
    assert order == sorted(order) and len(order) == len(rows)
    got = warc.read(index).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == wanted(rows)
    name = index.first().file
    with open_input(name) as f:
        text = gzip.decompress(f.read())  # the whole file is one valid sequence of members
    assert text.count(b"WARC/1.1\r\n") == index.where(F.col("file") == name).count()


def test_archive_query_and_nothing(spark):
    rows, table = pages(spark)
    got = warc.archive(table).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == wanted(rows)
    assert warc.archive(table.limit(0)).count() == 0


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/A?b=1#c") == warc.url_key("https://example.com/a?b=1") == "com,example)/a?b=1"
    assert warc.url_key("http://example.com:8080") == "com,example:8080)/"


def check(rows, got, shards):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(spark):
    rows = cases.texts()
    got = binpack.shard(cases.documents(spark)).collect()
    check(rows, got, 8)
    for r in got:
        assert r.tokens == len([w for w in re.split("[\x20\x09-\x0d]+", dict(rows).get(r.doc_id) or "") if w]) or r.doc_id in (7, None)
    assert binpack.shard(cases.documents(spark, [])).count() == 0


def test_balance_and_groups(spark):
    rng = random.Random(5)
    rows = [(i, cases.prose(i, rng.choice([2, 10, 40, 200]))) for i in range(1500)] + [(2000 + i, "copy " * 30 + str(i % 40)) for i in range(600)]
    got = binpack.shard(cases.documents(spark, rows)).collect()
    check(rows, got, 8)
    homes, load = defaultdict(set), Counter()
    for r in got:
        homes[r.text_crc32].add(r.shard)
        load[r.shard] += r.size
    assert all(len(h) == 1 for h in homes.values())
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 8


def test_a_group_of_a_third_is_split(spark):
    rows = [(i, "the same long text of a third of all rows" if i % 3 == 0 else cases.prose(i, 8)) for i in range(3000)]
    got = binpack.shard(cases.documents(spark, rows)).collect()
    check(rows, got, 8)
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert len(load) == 8 and max(load.values()) - min(load.values()) <= 0.05 * sum(load.values()) / 8
