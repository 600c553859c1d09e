"""WARC archives of captures, with an external merge of their index.

``write`` gives each task's captures to archive files (one gzip member per record) and keeps what an index needs: URL key,
time, file, place. A task sorts these entries in memory whenever it has ``RUN`` of them and writes the run to the
shared folder in blocks, so it stays small whatever it is given; the block table, which Spark commits, says what counts.

``merge`` turns the runs into one globally ordered index: groups of at most ``FAN_IN`` runs are merged by a loser tree (one
comparison per level of the tree for each entry), pass after pass, until one run is left. Every merge is cut into
ranges of the key at places taken from the blocks' first keys, so many tasks work on one merge, and each reads only the blocks
that its range meets, one block of each run at a time. ``histories`` returns the result in order.

Of records with equal payloads of at least ``least`` bytes the one with the least id is the response and the others
revisit it, without a payload of their own. Rows that repeat this id are responses too. Null payloads count as empty, null URLs as
empty, null times as the epoch; records without an id are written as well, come first, and are no one's response unless there is no
other (then all of them are). An empty table gives no file and no row. Other columns of the input are left alone.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.tables import Output, open_input, scratch, slices, stored

LEAST, ARCHIVE_BYTES = 100, 512 << 20
#: Entries of a run, of a block; runs merged at once; entries of a range of a merge.
RUN, BLOCK, FAN_IN, RANGE = 50_000, 1_000, 64, 100_000
BLOCKS = "run string, first string, last string, file string, at long, size long, entries long"


def url_key(url: str) -> str:
    """Host labels from the last on, then path and query; scheme, user, default port, ``www`` and fragment don't count."""
    try:
        parts = urlsplit(url.strip() if "//" in url else f"//{url.strip()}")
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.strip().lower()
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{where}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def record(kind: str, page: int | None, url: str, when: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record as a gzip member; a revisit has the payload's digest and length but not the payload."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:capture:{'' if page is None else page}>", f"WARC-Date: {when}",
             f"WARC-Target-URI: {''.join(c if ' ' < c < chr(127) else ''.join(f'%{b:02X}' for b in c.encode('utf-8', 'surrogatepass')) for c in url)}",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:capture:{refers_to}>"]
        payload = b""
    lines.append(f"Content-Length: {len(payload)}")
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


# --- runs --------------------------------------------------------------------------------------

def entry_key(key: str, when: str, page: int | None, file: str, at: int) -> str:
    """One string that sorts as (URL key, time, id, file, place); no key has a line end."""
    number = "0" if page is None else f"1{page + 2**63:020d}"
    return f"{key}\n{when}\n{number}\n{file}\n{at:015d}"


class RunWriter:
    """Sorted entries into blocks of a file; ``blocks`` are the rows of the block table."""

    def __init__(self, folder: str, run: str | None = None):
        self.out, self.blocks, self.waiting = Output(folder, ".run"), [], []
        self.run = run or self.out.uri

    def add(self, line: tuple[str, str]) -> None:
        self.waiting.append(line)
        if len(self.waiting) == BLOCK:
            self._block()

    def _block(self) -> None:
        data = zstandard.ZstdCompressor(level=1).compress(json.dumps(self.waiting).encode())
        self.blocks.append((self.run, self.waiting[0][0], self.waiting[-1][0], self.out.uri, self.out.write(data), len(data), len(self.waiting)))
        self.waiting = []

    def close(self) -> list[tuple]:
        if self.waiting:
            self._block()
        self.out.close()
        return self.blocks


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(7)], names=[c.split(" ")[0] for c in BLOCKS.split(", ")])


def read_run(blocks: list[dict], low: str | None, high: str | None) -> Iterator[tuple[str, str]]:
    """Entries of a run from ``low`` (with it) to ``high`` (without it), one block in memory."""
    for b in sorted(blocks, key=lambda b: b["first"]):
        with open_input(b["file"]) as f:
            lines = json.loads(zstandard.ZstdDecompressor().decompress(f.read_at(b["size"], b["at"])))
        for key, value in lines:
            if high is not None and key >= high:
                return
            if low is None or key >= low:
                yield key, value


def merged(runs: list[Iterator[tuple[str, str]]]) -> Iterator[tuple[str, str]]:
    """k-way merge by a loser tree: each inner node holds the loser of its match, the winner goes up.

    Of equal entries the earlier run's comes first.
    """
    k = len(runs)
    heads: list[tuple[str, str] | None] = [next(r, None) for r in runs]

    def beats(x: int, y: int) -> bool:
        if heads[x] is None or heads[y] is None:
            return heads[y] is None and (heads[x] is not None or x < y)
        return (heads[x][0], x) < (heads[y][0], y)

    losers = [-1] * k  # losers[0] is the overall winner; node i has children 2i and 2i + 1, leaves are k + run
    winner = [0] * (2 * k)
    for i in range(2 * k - 1, 0, -1):
        if i >= k:
            winner[i] = i - k
        else:
            a, b = winner[2 * i], winner[2 * i + 1]
            winner[i], losers[i] = (a, b) if beats(a, b) else (b, a)
    best = winner[1] if k > 1 else 0
    while k and heads[best] is not None:
        yield heads[best]
        heads[best] = next(runs[best], None)
        node = (best + k) // 2
        while node >= 1 and k > 1:
            if beats(losers[node], best):
                losers[node], best = best, losers[node]
            node //= 2


# --- jobs --------------------------------------------------------------------------------------

def captures(pages: DataFrame, id_col: str, url_col: str, payload_col: str, time_col: Column | None, least: int = LEAST) -> DataFrame:
    """The records to write: id, url, payload, when, digest, kind, refers_to.

    First records of repeated payloads come from a pre-aggregated count; only contents that occur twice are in that
    (written) table, so Spark knows its size and broadcasts it if small, or else shuffles the pages by digest, where it splits hot ones.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"),
                       F.coalesce(time_col if time_col is not None else F.lit(None), F.lit("1970-01-01").cast("timestamp")).alias("when"),
                       F.sha2(F.encode(payload, "UTF-8"), 256).alias("digest"), F.octet_length(payload).alias("bytes"))
    repeated = stored(own.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                      .where("n > 1 AND first_id IS NOT NULL").select(F.col("digest").alias("again"), "first_id"), "repeated_payloads")
    return own.join(repeated, (F.col("digest") == F.col("again")) & (F.col("bytes") >= least), "left").select(
        "page_id", "url", "payload", "when", "digest",
        F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def write(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES, run: int = RUN) -> DataFrame:
    """Write archives and sorted runs; returns the block table of the runs (written)."""
    spark = records.sparkSession
    folder, runs = scratch(spark, "warc"), scratch(spark, "warc_runs")

    def task(batches):
        archive, entries = None, []

        def flush():
            entries.sort()
            to = RunWriter(runs)
            for e in entries:
                to.add(e)
            entries.clear()
            return _table(to.close())

        for batch in slices(batches, 200):
            for r in batch.to_pylist():
                archive = archive or Output(folder, ".warc.gz")
                payload = r["payload"].encode("utf-8", "surrogatepass")
                when = r["when"].astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") if isinstance(r["when"], datetime) else "1970-01-01T00:00:00Z"
                member = record("revisit" if r["refers_to"] is not None else "response", r["page_id"], r["url"], when, payload, r["digest"], r["refers_to"])
                at = archive.write(member)
                key = url_key(r["url"]).replace("\n", " ")
                entries.append((entry_key(key, when, r["page_id"], archive.uri, at), json.dumps([r["page_id"], key, when, archive.uri, at, len(member)])))
                if archive.size >= archive_bytes:
                    archive.close()
                    archive = None
                if len(entries) >= run:
                    yield flush()
        if archive:
            archive.close()
        if entries:
            yield flush()

    return stored(records.mapInArrow(task, BLOCKS), "run_blocks")


def _tasks(blocks: DataFrame, group: str, range_entries: int) -> DataFrame:
    """Add to each block the ranges of its group's merge that it meets: ``part`` (range number), ``low``, ``high``.

    Ranges begin at first keys of blocks, about ``range_entries`` entries apart; the list of cuts is small: one in ``RANGE`` entries.
    """
    step = max(1, range_entries // BLOCK)
    chosen = blocks.where(F.pmod(F.xxhash64("first"), F.lit(step)) == 0).groupBy(group).agg(F.sort_array(F.collect_set("first")).alias("cuts"))
    met = blocks.join(chosen, group, "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<string>")))

    @F.pandas_udf("array<int>")
    def ranges(first, last, cuts):
        import pandas as pd

        return pd.Series([list(range(bisect_right(c, a), bisect_right(c, b) + 1)) for a, b, c in zip(first, last, map(list, cuts))])

    spread = met.withColumn("part", F.explode(ranges("first", "last", "cuts")))
    at = lambda i: F.when((i >= 0) & (i < F.size("cuts")), F.element_at("cuts", i + 1))
    return spread.withColumns({"low": at(F.col("part") - 1), "high": at(F.col("part"))}).drop("cuts")


def merge(blocks: DataFrame, fan_in: int = FAN_IN, range_entries: int = RANGE) -> DataFrame:
    """Merge passes until at most ``fan_in`` runs are left; returns the blocks of those."""
    spark = blocks.sparkSession
    while True:
        runs = blocks.select("run").distinct()
        n = runs.count()
        if n <= fan_in:
            return blocks
        folder = scratch(spark, "warc_runs")
        groups = -(-n // fan_in)
        grouped = blocks.withColumn("merge", F.pmod(F.xxhash64("run"), F.lit(groups)))

        blocks = stored(_tasks(grouped, "merge", range_entries).groupBy("merge", "part").applyInArrow(_merger(folder), BLOCKS), "run_blocks")


def _merger(folder: str):
    """A task that merges its range of a group's runs into a segment; a group's segments make its next run."""

    def one(key, part):
        out = RunWriter(folder, f"{folder}#{key[0].as_py()}")
        for line in merged(_opened(part)):
            out.add(line)
        return pa.Table.from_batches([_table(out.close())])

    return one


def _opened(part: pa.Table) -> list[Iterator[tuple[str, str]]]:
    runs: dict[str, list[dict]] = {}
    rows = part.to_pylist()
    for r in rows:
        runs.setdefault(r["run"], []).append(r)
    return [read_run(runs[k], rows[0]["low"], rows[0]["high"]) for k in sorted(runs)]


HISTORY = "part int, place long, page_id long, url_key string, when string, file string, at long, size long"


def histories(blocks: DataFrame, range_entries: int = RANGE) -> DataFrame:
    """The last merge: the index in global order (``part``, then ``place`` in it), each URL's captures by time."""

    def one(key, part):
        rows = [json.loads(v) for _, v in merged(_opened(part))]
        number = key[1].as_py()
        return pa.table([pa.array([number] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int64()),
                         *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())))],
                        names=[c.split(" ")[0] for c in HISTORY.split(", ")])

    whole = _tasks(blocks.withColumn("merge", F.lit(0)), "merge", range_entries)
    return whole.groupBy("merge", "part").applyInArrow(one, HISTORY)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, url_key string, captured string, part int, place long"


def read(index: DataFrame) -> DataFrame:
    """Read the archives back at the index's places: each file from front to back, each record checked against its digest."""

    def task(batches):
        name, source = None, None
        for batch in slices(batches, 1000):
            out = []
            for r in batch.to_pylist():
                if r["file"] != name:
                    if source:
                        source.close()
                    name, source = r["file"], open_input(r["file"])
                head, payload = parse(source.read_at(r["size"], r["at"]))
                kind, digest, size = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["X-Payload-Length"])
                if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                    raise ValueError(f"{r['file']} at {r['at']}: the payload isn't what its header says")
                page = head["WARC-Record-ID"][len("<urn:capture:"):-1]
                refers = head.get("WARC-Refers-To", "<urn:capture:>")[len("<urn:capture:"):-1]
                out.append((int(page) if page else None, size, digest, kind, int(refers) if refers else None, head["WARC-Target-URI"], r["url_key"], head["WARC-Date"], r["part"], r["place"]))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=[c.split(" ")[0] for c in READ.split(", ")])
        if source:
            source.close()

    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return index.repartition(parts, "file").sortWithinPartitions("file", "at").mapInArrow(task, READ)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: Column | None = None, least: int = LEAST) -> DataFrame:
    """Write, merge, and read back: one row per page from the archives."""
    return read(histories(merge(write(captures(pages, id_col, url_col, payload_col, time_col, least)))))
