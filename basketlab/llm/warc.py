"""WARC archives of pages, and their capture index by external merge.

Writing: every task writes one archive (a gzip member a record) and its own
capture run, the index entries of that archive sorted by URL key, timestamp and
page. Runs go to disk as Parquet. Merging: the runs' entries are dealt out by
ranges of (URL key, timestamp, page), so a URL that a third of the captures
share is cut into several ranges; each range merges the slices of its runs with
a loser tree, and ranges in order are the global capture history. Reading back
seeks the records through that index.

Equal payloads (by SHA-256) are stored once: the record with the largest page
id is the response, the others are revisits that refer to it.

Defined cases: a null payload is empty; a null url gives the empty URL key and
no target header; a page without id is a response if no page with id has its
payload, else a revisit; rows that repeat the responding page's id and payload
are responses too; an empty table gives no archive and an empty result; other
columns are left alone. Payloads are whole whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.llm import files
from basketlab.llm.common import new_folder, table, written

ENTRIES = 200_000  # index entries that a task holds at a time: of an archive, and about as many of a range
LEAST_BYTES = 0  # payloads from this size on are stored once
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "url_key string, captured string, page_id long, archive string, offset long, length long, record_type string"


# -- records ----------------------------------------------------------------
def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    """The same for every record of a page and payload, so that revisits can name it."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}:{digest}'.encode()).digest())}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, captured: str, refers_to: int | None) -> bytes:
    """One record, uncompressed: a response, or a revisit if ``refers_to`` is given."""
    digest = sha1_base32(payload)
    date = datetime.strptime(captured, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest) if refers_to is None else '<urn:uuid:' + str(uuid.UUID(bytes=hashlib.md5(f'{page_id}>{refers_to}:{digest}'.encode()).digest())) + '>'}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {PROFILE}", f"Page-Refers-To: {refers_to}"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, payload (None for a revisit).

    A response's digest is taken from its payload, which must agree with the header.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != named):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("Page-ID"), "payload_bytes": size, "payload_digest": named, "record_type": kind, "refers_to": number("Page-Refers-To"), "payload": payload if kind == "response" else None}


def gzip_member(raw: bytes, level: int = 3) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: host reversed, scheme, leading www., default port and fragment dropped."""
    if not url:
        return ""
    rest = url.strip().split("#", 1)[0]
    scheme, sep, tail = rest.partition("://")
    rest = tail if sep else rest
    cut = min((k for k in (rest.find(c) for c in "/?") if k >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2].lower(), rest[cut:]
    host = host.removesuffix(":80" if scheme.lower() == "http" else ":443").removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (path if path.startswith("/") else "/" + path)


# -- loser tree -------------------------------------------------------------
def merge_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Sorted runs as one sorted stream. A leaf a run; each inner place holds the loser of
    its match, so an item costs one comparison a level on the way up. Equal items keep the order of runs."""
    k = len(runs)
    if not k:
        return
    done = object()
    heads = [next(r, done) for r in runs]

    def beats(a: int, b: int) -> bool:
        if heads[a] is done or heads[b] is done:
            return heads[b] is done and (heads[a] is not done or a < b)
        return heads[a] < heads[b] or (heads[a] == heads[b] and a < b)

    losers = [-1] * k
    winners = [-1] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while heads[best] is not done:
        yield heads[best]
        heads[best] = next(runs[best], done)
        node = (best + k) // 2
        while node:
            if beats(losers[node], best):
                best, losers[node] = losers[node], best
            node //= 2


# -- Spark stages -----------------------------------------------------------
def with_roles(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is null for a response.

    Payloads are compared by digest; only digests and ids are aggregated. The
    join is by payload digest, whose hot values Spark can split.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("h", F.sha2("payload", 256))
    first = rows.select("h", "page_id").groupBy("h").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "response")
    joined = rows.join(first, "h", "left")
    other = (F.octet_length("payload") >= least_bytes) & F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select("page_id", "url", "payload", F.when(other, F.col("response")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes (page_id, url, payload, captured, refers_to) rows; returns the runs: each archive's
    entries in order, with ``place``. A task starts a new archive after ENTRIES records."""
    most = ENTRIES

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, out, at, entries = None, None, 0, []
        for b in batches:
            for page, url, payload, captured, refers in zip(b["page_id"], b["url"], b["payload"], b["captured"], b["refers_to"], strict=True):
                if out is None:
                    name, at = files.own_name("archive") + ".warc.gz", 0
                    out = files.open_out(folder, name)
                page, refers = (None if pd.isna(x) else int(x) for x in (page, refers))
                member = gzip_member(build_record(page, url, payload, captured, refers))
                out.write(member)
                entries.append((url_key(url), captured, -1 if page is None else page, page is None, at, len(member), "response" if refers is None else "revisit"))
                at += len(member)
                if len(entries) == most:
                    out.close()
                    yield from run(name, entries)
                    out, entries = None, []
        if out is not None:
            out.close()
            yield from run(name, entries)

    def run(name: str, entries: list[tuple]) -> Iterator[pd.DataFrame]:
        entries.sort()
        for k in range(0, len(entries), 10_000):
            key, captured, page, missing, offset, length, kind = zip(*entries[k : k + 10_000], strict=True)
            ids = pd.array([None if m else p for p, m in zip(page, missing, strict=True)], "Int64")
            yield pd.DataFrame({"url_key": key, "captured": captured, "page_id": ids, "archive": name, "offset": offset, "length": length, "record_type": kind, "place": range(k, k + len(key))})

    return written(records.mapInPandas(write, ENTRY + ", place long"), "capture-runs")


def merge_index(runs: DataFrame) -> DataFrame:
    """The runs' entries in global order of (url_key, captured, page_id); rows of one file, and files, in order.

    A task holds one range; more than ENTRIES entries a shuffle partition make more ranges.
    """
    order = ("url_key", "captured", F.col("page_id").asc_nulls_first())
    ranges = -(-runs.count() // ENTRIES)
    usual = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (runs.repartitionByRange(ranges, *order) if ranges > usual else runs.repartitionByRange(*order)).sortWithinPartitions("archive", "place")
    names = ("url_key", "captured", "page_id", "archive", "offset", "length", "record_type")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[str, list[tuple]] = {}
        for b in batches:
            ids = [(-1, True) if pd.isna(x) else (int(x), False) for x in b["page_id"]]
            for key, at, (page, none), archive, offset, length, kind in zip(b["url_key"], b["captured"], ids, b["archive"], b["offset"], b["length"], b["record_type"], strict=True):
                slices.setdefault(archive, []).append((key, at, page, none, archive, offset, length, kind))
        held: list[tuple] = []
        for e in merge_runs([iter(s) for s in slices.values()]):
            held.append(e)
            if len(held) == 10_000:
                yield frame(held)
                held = []
        if held:
            yield frame(held)

    def frame(held: list[tuple]) -> pd.DataFrame:
        key, at, page, none, archive, offset, length, kind = zip(*held, strict=True)
        ids = pd.array([None if m else p for p, m in zip(page, none, strict=True)], "Int64")
        return pd.DataFrame(dict(zip(names, (key, at, ids, archive, offset, length, kind), strict=True)))

    return written(dealt.drop("place").mapInPandas(merge, ENTRY), "capture-index")


def read_archives(index: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """Reads every indexed record: page_id, payload_bytes, payload_digest, record_type, refers_to,
    url_key, captured and, if asked for, payload (null for revisits)."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, captured string" + ", payload binary" * payload
    names = [f.split()[0] for f in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f = None, None
        for b in batches:
            out = []
            for archive, offset, length, key, at in zip(b["archive"], b["offset"], b["length"], b["url_key"], b["captured"], strict=True):
                if archive != name:
                    name, f = archive, files.open_in(folder, archive)
                f.seek(offset)
                r = parse_record(zlib.decompress(f.read(length), 31)) | {"url_key": key, "captured": at}
                out.append([r[n] for n in names])
                if len(out) == 500:
                    yield typed(out)
                    out = []
            if out:
                yield typed(out)

    def typed(out: list[list]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    # a stated number of tasks: index rows are small, the records behind them are not
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_archive = index.select("archive", "offset", "length", "url_key", "captured").repartition(tasks, "archive").sortWithinPartitions("archive", "offset")
    return by_archive.mapInPandas(read, schema)


def capture_time(column: str, start: datetime = datetime(2024, 1, 1, tzinfo=timezone.utc)):
    """14-digit time of a capture: ``column`` seconds after ``start`` (null: ``start``)."""
    seconds = F.coalesce(F.col(column), F.lit(0)) % 1_000_000_000 + F.lit(int(start.timestamp()))
    return F.date_format(F.timestamp_seconds(seconds), "yyyyMMddHHmmss")


# -- registered query -------------------------------------------------------
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    records = with_roles(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    runs = write_archives(records.withColumn("captured", capture_time("page_id")), folder)
    return read_archives(merge_index(runs), folder).drop("url_key", "captured")
