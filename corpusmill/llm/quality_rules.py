"""Quality rules with thresholds learned per language and source from mergeable quantile sketches.

Every text is measured once (words, symbols, repeated lines and windows, capitals). The measures are ratios
in whole numbers, so that their distribution fits a histogram with relative bucket width (the sketch): a
bucket is the leading bits of the value. Such sketches merge by adding counts, in any order and with the same
result, which a sum per (language, source, measure, bucket) does on the map side first.

A group is judged by its own sketch with those of its language and of the whole corpus merged in: the first counts as
OF_LANG rows, the second as OF_ALL, whatever their own size, so they decide in a small group and fade as it grows. From
the merged sketch come the median, the quantile TAIL (and 1 - TAIL for low values), and the least step that a text can
make in the measure: that of one more symbol, line or window in a text of the group's median size, known from sketches
of the sizes. A limit lies REACH times beyond the tail: REACH times the distance of tail and median, plus REACH such
steps. So it follows the group in all three, there is no fixed cutoff, and up to a tenth of a group may be junk without
moving its limits much. A group most of whose texts are full of symbols keeps them: that is usual there.

Defined results: null languages and sources are groups of their own; null and empty texts have no words, are in no sketch and
fail the base rules; texts of any length are measured whole; a value at the limit is within it; repeated rows are
judged each; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import BREAKS, Words, find_words, ngram_hashes, per_text, slices
from corpusmill.session import materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 3

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in SYMBOLS]] = 1
_WORD_CHAR = np.where(BREAKS | ((np.arange(256) & 0xC0) == 0x80), 0, 1)
_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[ord("A"):ord("Z") + 1] = 1

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def _per_text_of_bytes(words: Words, weights: np.ndarray) -> np.ndarray:
    return per_text(words.offsets, weights[words.data])


def _again(keys: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """For each key, its place among equal keys of the same text (0: first), and how often it occurs there."""
    order = np.lexsort((keys, text_of))
    k, t = keys[order], text_of[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(k)))
    place = np.empty(len(k), np.int64)
    place[order] = np.arange(len(k)) - np.repeat(first, size)
    often = np.empty(len(k), np.int64)
    often[order] = np.repeat(size, size)
    return np.stack([place, often])


def text_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measures in STATS of a large_string column without nulls."""
    words = find_words(texts)
    n, text_of = words.n_texts, words.text_of

    windows, first = ngram_hashes(words.hashes, text_of, WINDOW)
    repeated = first[_again(windows, text_of[first])[1] > 1]
    covered = np.zeros(len(words.start), bool)
    for k in range(WINDOW):
        covered[repeated + k] = True

    breaks = np.flatnonzero(words.data == 0x0A)
    line_start = np.unique(np.concatenate([words.offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(words.data)]
    line_text = np.searchsorted(words.offsets, line_start, side="right") - 1
    bound = np.append(line_start, len(words.data))[1:]
    line_end = np.minimum(bound, words.offsets[line_text + 1])
    line_end = line_end - ((line_end > line_start) & (words.data[np.maximum(line_end, 1) - 1] == 0x0A))
    full = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    line_start, line_end, line_text = line_start[full], line_end[full], line_text[full]
    duplicate = _again(words.span_hash(line_start, line_end), line_text)[0] > 0

    return {
        "n_words": words.counts,
        "word_chars": _per_text_of_bytes(words, _WORD_CHAR),
        "n_symbols": _per_text_of_bytes(words, _SYMBOL),
        "n_dup_lines": np.bincount(line_text[duplicate], minlength=n),
        "n_repeat_words": np.bincount(text_of[covered], minlength=n),
        "n_lines": np.bincount(line_text, minlength=n),
        "n_capitals": _per_text_of_bytes(words, _CAPITAL),
    }


def measure(docs: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """`keys` and the STATS of each text. Null and empty texts have no words, lines or symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                stats = text_statistics(part.column(part.num_columns - 1))
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                columns += [pa.array(stats[name].astype(np.int64)) for name in STATS]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], *STATS])

    rows = docs.select(*keys, F.col(text).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + [f"{s} bigint" for s in STATS])
    return rows.mapInArrow(run, schema)


# measure: (numerator, factor, denominator, what one more event adds to the numerator, is low unusual too)
MEASURES = {
    "word_length": ("word_chars", 100, "n_words", 1, True),
    "symbols": ("n_symbols", 1000, "n_words", 1, False),
    "duplicate_lines": ("n_dup_lines", 1000, "n_lines", 1, False),
    "repeats": ("n_repeat_words", 1000, "n_words", WINDOW, False),
    "capitals": ("n_capitals", 1000, "word_chars", 1, False),
}
SIZES = ["n_words", "n_lines", "word_chars"]
# Per cent of the rows; and how far beyond the tail a limit lies.
TAIL = 90
REACH = 4
# As how many rows the sketches of the language and of all texts count.
OF_LANG = 100
OF_ALL = 50
# Counts are whole numbers of this part of a row, so that merged sketches do not depend on the order of sums.
_PARTS = 1 << 20


def value_of(name: str) -> Column:
    if name in SIZES:
        return F.col(name)
    numerator, factor, denominator, _, _ = MEASURES[name]
    return F.floor(F.col(numerator) * factor / F.greatest(F.col(denominator), F.lit(1))).cast("bigint")


def bucket_of(value: Column) -> Column:
    """The value with all but its six leading bits cleared: exact below 64, within 1/32 above."""
    extra = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, extra), extra)


def sketch(stats: DataFrame, *by: str) -> DataFrame:
    """(by..., measure, bucket, n): the mergeable histograms of texts with at least one word."""
    values = F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), bucket_of(value_of(m)).alias("bucket")) for m in [*MEASURES, *SIZES]]))
    return stats.where("n_words > 0").select(*by, values).groupBy(*by, "measure", "bucket").agg(F.count("*").alias("n"))


def cells(sketches: DataFrame, *by: str, name: str) -> DataFrame:
    """(by..., measure, name): merged sketches as lists of (bucket, n), which hold at most 32 buckets for each bit of a value."""
    merged = sketches.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    return merged.groupBy(*by, "measure").agg(F.collect_list(F.struct("bucket", "n")).alias(name))


def _scaled(listed: Column, rows: int | None) -> Column:
    """The counts of a sketch in parts of a row, as if it held so many rows; its own number with None."""
    if rows is None:
        return F.transform(listed, lambda c: F.struct(c["bucket"].alias("bucket"), (c["n"] * _PARTS).alias("n")))
    total = F.aggregate(listed, F.lit(0).cast("bigint"), lambda t, c: t + c["n"]).cast("decimal(38,0)")
    share = lambda c: F.floor(c["n"].cast("decimal(18,0)") * F.lit(rows * _PARTS).cast("decimal(12,0)") / total).cast("bigint")
    return F.transform(listed, lambda c: F.struct(c["bucket"].alias("bucket"), share(c).alias("n")))


def _quantile(merged: Column, total: Column, percent: int) -> Column:
    """The least bucket below or in which that share of the merged, sorted cells lies."""
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("at"))

    def add(state: Column, cell: Column) -> Column:
        seen = state["seen"] + cell["n"]
        here = state["at"].isNull() & (seen * 100 >= total * percent)
        return F.struct(seen.alias("seen"), F.when(here, cell["bucket"]).otherwise(state["at"]).alias("at"))

    return F.aggregate(merged, start, add, lambda state: state["at"])


def limits(sketches: DataFrame) -> DataFrame:
    """(lang, source, <measure>_low, <measure>_high): what is usual in each group."""
    own = cells(sketches, "lang", "source", name="own")
    of_lang = cells(sketches, "lang", name="of_lang").withColumnsRenamed({"lang": "_lang", "measure": "_m"})
    of_all = cells(sketches, name="of_all").withColumnRenamed("measure", "_a")
    joined = own.join(of_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_m"))).join(of_all, F.col("measure") == F.col("_a"))
    merged = F.array_sort(F.concat(_scaled(F.col("own"), None), _scaled(F.col("of_lang"), OF_LANG), _scaled(F.col("of_all"), OF_ALL)))
    summed = joined.select("lang", "source", "measure", merged.alias("merged"))
    summed = summed.withColumn("total", F.aggregate("merged", F.lit(0).cast("bigint"), lambda t, c: t + c["n"]))
    at = {f"q{p}": _quantile(F.col("merged"), F.col("total"), p) for p in (100 - TAIL, 50, TAIL)}
    quantiles = F.struct(*[c.alias(n) for n, c in at.items()])
    known = summed.groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("measure", quantiles))).alias("q"))
    columns = []
    for m, (_, factor, denominator, event, two_sided) in MEASURES.items():
        q = F.col("q")[m]
        step = F.floor(F.lit(REACH * factor * event) / F.greatest(F.col("q")[denominator]["q50"], F.lit(1))).cast("bigint")
        columns.append((q[f"q{TAIL}"] + (q[f"q{TAIL}"] - q["q50"]) * REACH + step).alias(f"{m}_high"))
        low = q[f"q{100 - TAIL}"] - (q["q50"] - q[f"q{100 - TAIL}"]) * REACH - step if two_sided else F.lit(-1).cast("bigint")
        columns.append(low.alias(f"{m}_low"))
    return known.select("lang", "source", *columns)


def apply_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", key: str = "doc_id") -> DataFrame:
    """Per document: `key`, lang, source, STATS, base_failed, kept and the names of the limits it broke.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows. kept: not
    base_failed and all measures within the limits of the group. Null languages and sources are groups of
    their own; repeated rows are judged each; an empty table gives no rows; other columns are not read.
    """
    named = docs.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    stats = materialize(measure(named, "doc_id", "lang", "source"), "quality-stats")
    allowed = limits(sketch(stats, "lang", "source")).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    # The limits are joined once per distinct group by Catalyst's choice; a hot group is split by adaptive
    # execution, as nothing here needs its rows together.
    joined = stats.join(allowed, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    broken = F.array_compact(F.array(*[
        F.when((value_of(m) > F.col(f"{m}_high")) | (value_of(m) < F.col(f"{m}_low")), F.lit(m)) for m in MEASURES
    ]))
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    judged = joined.select("doc_id", "lang", "source", *STATS, base.alias("base_failed"), broken.alias("broken"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
