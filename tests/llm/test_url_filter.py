import random

import pytest
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import url_filter


def brute(url, entries):
    """(host, path, rule, verdict) by trying every entry."""
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for entry, verdict, is_rule in entries:
        own = entry.split("/", 1)[0]
        start = entry[len(own):]
        if own and host and (host == own or host.endswith("." + own)) and path.startswith(start):
            best = max(best or (False,), (is_rule, len(entry), len(own), verdict, entry))
    return host, path, best[4] if best and best[0] else None, best[3] if best else "allow"


ENTRIES = [
    ("com/", "allow", True), ("a.com/x/", "block", True), ("b.a.com/x/", "allow", True), ("a.com/x", "allow", True), ("net/ü/", "block", True), ("é.org", "block", False),
    ("b.net", "block", False), ("b.net/x/ok", "allow", False), ("net/x/", "allow", True), ("twice.org/", "allow", True), ("twice.org/", "block", True), ("/x", "block", True), ("", "block", True),
]


@pytest.mark.parametrize("key_bits", [64, 3, 0])
def test_verdicts_match_brute_force(spark, key_bits):
    """Also where keys clash, down to one key for all strings."""
    rng = random.Random(5)
    odd = [
        None, "", "no scheme.com/x/", "http://", "://com", "http:///x/", "http://COM", "HTTP://A.Com/x/y", "http://a.com", "http://a.com?x=/x/", "http://a.com#/", "http://twice.org/", "http://.com/",
        "http://a..com/x/1", "http://u:p@a.com:80/x/", "http://a.com/x/\n/2", "see http://b.net/x/ok://a.com/", "http://é.org/", "http://x.É.org/", "http://" + "a." * 3000 + "com/" + "x/" * 4000,
    ]
    host = lambda: ".".join(rng.choice(["a", "b", "www", "É", "é"]) for _ in range(rng.randint(0, 3)))
    made = [f"http://{host()}.{rng.choice(['com', 'net', 'org'])}{rng.choice(['', '/', '/x', '/x/', '/x/ok', '/ü/', '/y/x/'])}{rng.choice(['', '?q=/x/', '#top', 'z'])}" for _ in range(600)]
    urls = [*odd, *made, *made[:50]]
    pages = spark.createDataFrame([(i if i != 7 else None, u, "k") for i, u in enumerate(urls)], "page_id bigint, url string, entry string")
    entries = spark.createDataFrame([*ENTRIES, (None, "block", True)], "entry string, verdict string, is_rule boolean")
    found = url_filter.filter_urls(pages, entries, key_bits=key_bits).collect()
    wanted = [(i if i != 7 else None, *brute(u, ENTRIES)) for i, u in enumerate(urls)]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_keys_are_xxhash(spark):
    texts = ["", "com/", "x" * 100, "é"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()
    assert all(h % 2**64 == xxhash.xxh64_intdigest(t.encode(), seed=42) for t, h in rows)


def test_block_list_of_unwanted_names(spark):
    urls = ["http://m.cheap-pills.example.com/", "http://cheap-pills.example.com/2", "http://pills.casino-win.org/", "http://adults.org/", "http://pills/", "http://a.casino/", None]
    found = url_filter.unwanted_hosts(spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    assert sorted(r.entry for r in found) == ["casino-win.org", "cheap-pills.example.com"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "entry string, verdict string, is_rule boolean")
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id bigint, url string")
    assert [tuple(r) for r in url_filter.filter_urls(pages, none).collect()] == [(1, "a.com", "/x", None, "allow")]
    assert url_filter.filter_urls(pages.limit(0), url_filter.rule_entries(spark, url_filter.RULES)).collect() == []
