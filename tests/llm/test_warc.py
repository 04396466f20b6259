import base64
import gzip
import hashlib
import random

from basketlab.llm import warc as W
from basketlab.llm.common import new_folder

SCHEMA = "page_id long, url string, html string"


def test_loser_tree_merges_in_order():
    rng = random.Random(1)
    for k in range(17):
        runs = [sorted((rng.randint(0, 30), i) for _ in range(rng.randint(0, 30))) for i in range(k)]
        assert list(W.merge_runs([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_url_keys():
    cases = {"https://www.A.example.net:443/en?x=1#f": "net,example,a)/en?x=1", "http://u:p@h.com:80": "com,h)/", "x": "x)/", None: "", "": "", "h.com?q": "com,h)/?q"}
    assert {u: W.url_key(u) for u in cases} == cases


def test_record_form():
    raw = W.build_record(4, "http://a/\r\nX: é", b"body\r\n\r\n", "20240102030405", None)
    head = raw.split(b"\r\n\r\n")[0].decode().split("\r\n")
    assert head[0] == "WARC/1.1" and "WARC-Target-URI: http://a/%0D%0AX:%20%C3%A9" in head and "WARC-Date: 2024-01-02T03:04:05Z" in head
    assert gzip.decompress(W.gzip_member(raw)) == raw and W.parse_record(raw)["payload"] == b"body\r\n\r\n"


def brute(rows):
    top = {}
    for p, _, h in rows:
        if p is not None:
            top[h or ""] = max(top.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        b, r = (h or "").encode(), top.get(h or "")
        ref = r if r is not None and r != p else None
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


def write(spark, df):
    folder = new_folder(spark, "test")
    runs = W.write_archives(W.with_roles(df).withColumn("captured", W.capture_time("page_id")), folder)
    return W.merge_index(runs), folder


def test_round_trip(spark, make):
    rows = [(1, "http://a\r\nX: y", "é\r\n\r\n"), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "u", ""), (None, None, "zz"), (None, "q", "zz"), (9, "http://b.c/\U0001F600", "é\r\n\r\n"), (9, "v", "other"), (9, "v", "other"), (10, "big", "x" * 300_000)]
    rows += [(100 + i, "http://hot.example/", "same") for i in range(40)]
    index, folder = write(spark, make(rows, SCHEMA, clash=("payload", "refers_to")))
    back = W.read_archives(index, folder, payload=True).collect()
    assert sorted([tuple(r)[:5] for r in back], key=str) == brute(rows)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in back)
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in index.collect()]
    assert keys == sorted(keys)


def test_small_payloads_may_stay_responses(make):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "long enough"), (4, "u", "long enough")]
    got = {r.page_id: r.refers_to for r in W.with_roles(make(rows, SCHEMA), least_bytes=5).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_empty(spark, make):
    index, folder = write(spark, make([], SCHEMA))
    assert W.read_archives(index, folder).count() == 0


def test_a_task_holds_a_bounded_number_of_entries(spark, make, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(W, "ENTRIES", 20)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(i, f"http://h{i % 7}.example/{i}", f"page {i}") for i in range(40 * (usual + 1))]
    index, folder = write(spark, make(rows, SCHEMA))
    ranges = [r["count"] for r in index.groupBy(F.input_file_name()).count().collect()]
    archives = [r["count"] for r in index.groupBy("archive").count().collect()]
    assert max(archives) <= 20 and max(ranges) <= 60 and sum(ranges) == len(rows)
    keys = [(r.url_key, r.captured, r.page_id) for r in index.collect()]
    assert sorted(keys) == sorted((W.url_key(u), k[1], p) for (p, u, _), k in zip(rows, sorted(keys, key=lambda k: k[2]), strict=True))
    assert sorted(tuple(r)[:5] for r in W.read_archives(index, folder).collect()) == sorted(brute(rows))
