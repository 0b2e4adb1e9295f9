"""URL filter: rules and block lists as sorted arrays of 64-bit digests, probed by binary search.

An entry is a host with the start of a path, written as one string (`example.com/en/`); it fits its host and all
subdomains, if the path starts with the entry's. A url can thus only be hit by the strings made of an end of its
host and a start of its path, with as many labels and characters as some entry has. These candidates are worked
out for distinct heads of urls (host and the first characters of the path), never url by url.

Entries and distinct candidates are dealt by their 64-bit xxhash key. The entries of a part come first, in the
order of their keys: they go to unnamed scratch files of the task and are mapped into memory as arrays
(keys, offsets, strings, marks). The candidates then stream past in batches, each one binary search over the mapped keys for
the whole batch. Where a key is found the stored string is compared, and that of the next entry while keys are
equal, so two strings with one key are never mixed up. A part's arrays may exceed the task's memory, since they are
mapped, not read; nothing is broadcast that grows, and no other task reads the scratch files.

Defined results: a null url or one without `://` has an empty host and path and is allowed; an empty host fits
nothing; a url without a path has only entries without path; repeated rows are judged each; an entry that is given
twice blocks if one of the two does; of rules that fit, the longest string wins, and of equally long ones
the one with the longer host; any rule goes before any block list. Hosts and paths of any length are read whole. An
empty table gives no rows; other columns, whatever their names, are neither read nor returned.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.words import string_column, text_bytes
from corpusmill.operators.hotkeys import lookup_join
from corpusmill.session import materialize

# The rules of the registered query, and the words that mark a host name as unwanted.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
UNWANTED = ["ads", "adult", "bets", "casino", "pills", "porn", "spam", "warez", "xxx"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?` or `#`, with A-Z lower-cased; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?` or `#`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_entries(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(entry, verdict, is_rule) of a list of rules, which is a setting and small."""
    return spark.createDataFrame([(entry, verdict, True) for entry, verdict in rules], "entry string, verdict string, is_rule boolean")


def unwanted_hosts(urls: DataFrame, url: str = "url", words: list[str] = UNWANTED) -> DataFrame:
    """(entry, verdict, is_rule): a block list of the sites in `urls` whose name has an unwanted word.

    A name is a label other than the last, its words are parted by hyphens. The entry begins with the last such
    label, so it covers all other hosts of that site too.
    """
    labels = F.split(F.col("host"), r"\.")
    places = F.filter(F.sequence(F.lit(1), F.size("labels") - 1), lambda i: F.arrays_overlap(F.split(F.element_at("labels", i), "-"), F.array(*map(F.lit, words))))
    hosts = urls.select(host_of(F.col(url)).alias("host")).distinct().withColumn("labels", labels).where(F.size("labels") > 1)
    listed = hosts.withColumn("place", F.array_max(places)).where("place IS NOT NULL")
    entry = F.array_join(F.slice("labels", F.col("place"), F.size("labels")), ".")
    return listed.select(entry.alias("entry"), F.lit("block").alias("verdict"), F.lit(False).alias("is_rule")).distinct()


def _candidates(host: Column, start: Column, paths: list[int], most_labels: int) -> Column:
    """All strings of an end of the host, of at most so many labels, and a start of the path of one of the lengths."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    ends = F.transform(F.sequence(F.greatest(n - most_labels, F.lit(0)) + 1, n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    lengths = F.filter(F.array(*map(F.lit, paths)), lambda k: k <= F.length(start))
    return F.array_distinct(F.flatten(F.transform(ends, lambda e: F.transform(lengths, lambda k: F.concat(e, F.substring(start, F.lit(1), k))))))


class DigestArray:
    """Sorted 64-bit keys with their strings and marks, in files that are mapped into memory."""

    def __init__(self) -> None:
        self.files = [tempfile.TemporaryFile() for _ in range(4)]
        self.files[1].write(np.zeros(1, np.int64))
        self.n = self.size = 0
        self.keys = self.strings = self.marks = None

    def add(self, keys: np.ndarray, strings: pa.Array, marks: np.ndarray) -> None:
        """More entries, in the order of their keys, each with a mark of one byte."""
        data, offsets = text_bytes(strings)
        for file, part in zip(self.files, (keys, offsets[1:] + self.size, data, marks), strict=True):
            file.write(np.ascontiguousarray(part))
        self.n, self.size = self.n + len(keys), self.size + len(data)

    def map(self) -> None:
        for file in self.files:
            file.flush()
        if self.n:
            self.keys, offsets, texts, self.marks = [np.memmap(f, kind, "r") for f, kind in zip(self.files, (np.int64, np.int64, np.uint8, np.uint8))]
            self.strings = pa.Array.from_buffers(pa.large_string(), self.n, [None, pa.py_buffer(offsets), pa.py_buffer(texts)])

    def find(self, keys: np.ndarray, strings: pa.Array) -> np.ndarray:
        """The place of each string among the entries, or -1."""
        place = np.full(len(keys), -1, np.int64)
        if not self.n:
            return place
        at = np.searchsorted(self.keys, keys)
        left = np.flatnonzero(at < self.n)
        while len(left):
            left = left[self.keys[at[left]] == keys[left]]
            same = np.asarray(pc.equal(self.strings.take(pa.array(at[left])), strings.take(pa.array(left))))
            place[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1  # another string under the same key
            left = left[at[left] < self.n]
        return place

    def close(self) -> None:
        self.keys = self.strings = self.marks = None
        for file in self.files:
            file.close()


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (asked, key, entry, n, mark): the entries in the order of their keys, then the candidates."""
    array, mapped = DigestArray(), False
    try:
        for batch in batches:
            cut = int(np.searchsorted(batch.column(0).to_numpy(zero_copy_only=False), True))
            keys, strings = batch.column(1).to_numpy(), string_column(batch.column(2))
            if cut:
                array.add(keys[:cut], strings[:cut], batch.column(4).to_numpy()[:cut].astype(np.uint8))
            if cut < batch.num_rows:
                if not mapped:
                    array.map()
                    mapped = True
                place = array.find(keys[cut:], strings[cut:])
                found = np.flatnonzero(place >= 0)
                marks = array.marks[place[found]] if array.n else np.zeros(0, np.uint8)
                at = pa.array(found + cut)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).take(at), batch.column(3).take(at), pa.array(marks.astype(np.int32))], names=["entry", "n", "mark"]
                )
    finally:
        array.close()


def probe(candidates: DataFrame, entries: DataFrame, key_bits: int = 64) -> DataFrame:
    """(entry, n, verdict, is_rule) of those candidates (entry, n) that are entries (entry, verdict, is_rule).

    Candidates and entries are distinct strings, so no key is hot. Fewer `key_bits` make keys clash, for tests.
    """
    key = F.xxhash64("entry") if key_bits == 64 else F.pmod(F.xxhash64("entry"), F.lit(1 << key_bits))
    mark = F.when(F.col("verdict") == "block", 1).otherwise(0) + F.when(F.col("is_rule"), 2).otherwise(0)
    listed = entries.select(F.lit(False).alias("asked"), key.alias("key"), "entry", F.lit(0).cast("bigint").alias("n"), mark.alias("mark"))
    asked = candidates.select(F.lit(True).alias("asked"), key.alias("key"), "entry", "n", F.lit(0).alias("mark"))
    dealt = listed.unionByName(asked).repartition("key").sortWithinPartitions("asked", "key", "entry")
    found = dealt.mapInArrow(_search, "entry string, n bigint, mark int")
    return found.select("entry", "n", F.when(F.col("mark") % 2 == 1, "block").otherwise("allow").alias("verdict"), (F.col("mark") >= 2).alias("is_rule"))


def filter_urls(pages: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", key_bits: int = 64) -> DataFrame:
    """(key, host, path, rule, verdict) for each row: the verdict of the longest rule, else of the block list, else allow.

    `entries` is (entry, verdict, is_rule). `rule` is the rule that decided, null if none did.
    """
    usable = entries.where("entry IS NOT NULL AND substring(entry, 1, 1) NOT IN ('', '/')")
    # One string blocks if one of its entries does; a rule and a list entry of the same string are one rule.
    best = F.max(F.struct("is_rule", "verdict"))
    usable = materialize(usable.groupBy("entry").agg(best.alias("b")).select("entry", "b.verdict", "b.is_rule"), "entries")
    host, rest = F.substring_index("entry", "/", 1), F.length("entry") - F.length(F.substring_index("entry", "/", 1))
    shape = usable.agg(F.sort_array(F.collect_set(rest)).alias("paths"), F.max(F.size(F.split(host, r"\."))).alias("labels")).first()
    paths, most_labels = shape["paths"] or [0], shape["labels"] or 1  # one number per length that occurs

    judged = pages.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path"))
    start = F.substring("_path", 1, paths[-1])
    # A host holds no slash and a path starts with one, so the two stay apart in one string.
    judged = judged.withColumn("_head", F.concat("_host", start))
    heads = judged.where("_host <> ''").groupBy("_head").agg(F.count("*").alias("n"))
    heads = materialize(heads.withColumn("_host", F.substring_index("_head", "/", 1)), "heads")
    start = F.substring(F.col("_head"), F.length("_host") + 1, F.length("_head"))
    asked = heads.select("_head", F.col("n").alias("rows"), F.explode(_candidates(F.col("_host"), start, paths, most_labels)).alias("entry"))
    hits = materialize(probe(asked.groupBy("entry").agg(F.count("*").alias("n")), usable, key_bits), "hits")
    # A short entry (`com/`) is a candidate of very many heads.
    fits = lookup_join(asked, hits.withColumn("found", F.lit(True)), "entry", "n").where("found")
    order = F.struct("is_rule", F.length("entry"), F.length(F.substring_index("entry", "/", 1)))
    chosen = fits.groupBy("_head").agg(F.max_by(F.struct("entry", "verdict", "is_rule"), order).alias("c"), F.first("rows").alias("n"))
    chosen = materialize(chosen.select("_head", "n", F.when(F.col("c.is_rule"), F.col("c.entry")).alias("rule"), "c.verdict"), "verdicts")
    decided = lookup_join(judged, chosen, "_head", "n")
    return decided.select(
        F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )
