"""Mixing overlapping sources to target weights by min-cost flow.

A document can belong to several sources. Documents with the same memberships are interchangeable, so words are
added up by membership pattern, and only the patterns meet in the flow: each pattern offers its words once at no
cost, a second time at cost 1, a third time at cost 2 and so on, and each source asks for its target. The
cheapest flow says how many words of each pattern are taken. Within a pattern every document is taken as many
times as fits for all of them, and the rest goes to documents in the order of a seeded draw, up to a cut.

The cut is found from sums over buckets of the draw and, in the bucket that holds it, over the draws
themselves; no pattern is ever sorted as a whole.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.names import fresh
from corpusmill.session import materialize

# The flow runs on the driver over one row per membership pattern; more than this many is refused.
MOST_PATTERNS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
_DRAW_DIGITS = 15
_BUCKET_DIGITS = 4

Pattern = tuple[str | None, ...]


def source_order(name: str | None) -> tuple[bool, str]:
    """By code point, null last."""
    return (name is None, name or "")


def capped_targets(sizes: dict[str | None, int], weights: Sequence[float] = (3, 1, 2), share: float = 1.5, copies: int = 2) -> dict[str | None, float]:
    """Targets of sources: `share` of all sizes by weight, none above `copies` times its size, the excess reshared by weight.

    The weights repeat over the sources in order.
    """
    names = sorted(sizes, key=source_order)
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    targets: dict[str | None, float] = {}
    left, open_ = share * sum(sizes.values()), list(names)
    while open_:
        total = sum(weight[n] for n in open_)
        full = [n for n in open_ if left * weight[n] / total > copies * sizes[n]]
        if not full:
            targets.update({n: left * weight[n] / total for n in open_})
            break
        targets.update({n: float(copies * sizes[n]) for n in full})
        left -= sum(copies * sizes[n] for n in full)
        open_ = [n for n in open_ if n not in targets]
    return targets


def cheapest_flow(words: dict[Pattern, int], quotas: dict[str | None, int], copies: int) -> dict[Pattern, int]:
    """Words to take of each pattern: as much of the quotas as can be served, at the lowest sum of repetition costs.

    Successive cheapest paths over the network start - patterns - sources - end. A path carries all that its
    narrowest arc allows.
    """
    head: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    arcs: dict[object, list[int]] = {}
    ends: list[object] = []

    def arc(a: object, b: object, capacity: int, price: int) -> int:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            arcs.setdefault(x, []).append(len(head))
            head.append(len(ends))
            ends.append(y)
            room.append(c)
            cost.append(p)
        return len(room) - 2

    supply = {p: [arc("start", ("pattern", p), n, k) for k in range(copies)] for p, n in words.items() if n > 0}
    for p in supply:
        for s in sorted(set(p), key=source_order):
            arc(("pattern", p), ("source", s), copies * words[p], 0)
    for s, quota in quotas.items():
        arc(("source", s), "end", quota, 0)
    while True:
        best: dict[object, int] = {"start": 0}
        came: dict[object, int] = {}
        queue, waiting = deque(["start"]), {"start"}
        while queue:
            here = queue.popleft()
            waiting.discard(here)
            for e in arcs.get(here, ()):
                if room[e] > 0 and best[here] + cost[e] < best.get(ends[e], 1 << 60):
                    best[ends[e]], came[ends[e]] = best[here] + cost[e], e
                    if ends[e] not in waiting:
                        waiting.add(ends[e])
                        queue.append(ends[e])
        if "end" not in best:
            break
        path, at = [], "end"
        while at != "start":
            path.append(came[at])
            at = ends[came[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    return {p: sum(room[e ^ 1] for e in supply.get(p, ())) for p in words}


def draw_of(key: str, seed: str = "mix") -> Column:
    """A seeded number below 16**15 that depends on the row's key alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _DRAW_DIGITS), 16, 10).cast("bigint")


def mix_sources(
    docs: DataFrame, sources: Column, targets: Callable[[dict[str | None, int]], dict[str | None, float]], *,
    key: str = "doc_id", text: str = "text", copies: int = 2, seed: str = "mix", size_name: str = "size", taken_name: str = "taken",
) -> tuple[DataFrame, dict[str | None, int], dict[str | None, float]]:
    """(documents with their size and the words taken added under the given names, words per source, target per source).

    `sources` is a list of the sources a document belongs to; `targets` maps words per source to targets.
    size: words of the text, 0 for null; taken: size times the copies in the mix, at most `copies`. Reruns
    agree: the draw depends on the key. Rows with one key and one pattern are taken or left together. Null
    keys and sources are keys and sources of their own; an empty table gives no rows. All columns of `docs` stay.

    Where the share of a pattern ends is found among the documents of one of 16**_BUCKET_DIGITS buckets of its draw, so
    a pattern with a third of all rows sorts that fraction of them in one task.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    own_pattern, own_draw, own_size, own_all, own_edge, own_last = fresh(docs, "_mix_pattern", "_mix_draw", "_mix_size", "_mix_all", "_mix_edge", "_mix_last")
    drawn = docs.select("*", F.array_sort(sources).alias(own_pattern), draw_of(key, seed).alias(own_draw))
    rows = materialize(
        drawn.select(F.col(key).alias("_mix_key"), size.alias("size"), F.col(own_pattern).alias("_mix_pattern"), F.col(own_draw).alias("_mix_draw")), "mix-sizes"
    )

    found = rows.groupBy("_mix_pattern").agg(F.sum("size").alias("size")).limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    words: dict[Pattern, int] = {tuple(r._mix_pattern): r.size for r in found}
    sizes: dict[str | None, int] = {}
    for pattern, n in words.items():
        for name in set(pattern):
            sizes[name] = sizes.get(name, 0) + n
    wanted = targets(sizes)
    flow = cheapest_flow(words, {s: round(t) for s, t in wanted.items()}, copies)

    # One row per pattern: copies for all its documents, and the words that remain.
    plan = [(list(p), flow[p] // n if n else 0, flow[p] % n if n else 0) for p, n in words.items()]
    element = rows.schema["_mix_pattern"].dataType.simpleString()
    shares = F.broadcast(spark.createDataFrame(plan, f"_mix_pattern {element}, _mix_all bigint, _mix_rest bigint"))

    bucket = F.call_function("shiftright", F.col("_mix_draw"), F.lit(4 * (_DRAW_DIGITS - _BUCKET_DIGITS)))
    by_bucket = rows.groupBy("_mix_pattern", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("_mix_pattern").orderBy("bucket")
    edge = (
        by_bucket.withColumn("before", F.sum("words").over(running) - F.col("words")).join(shares, "_mix_pattern")
        .where((F.col("before") <= F.col("_mix_rest")) & (F.col("before") + F.col("words") > F.col("_mix_rest")))
        .select(F.col("_mix_pattern").alias("_p"), F.col("bucket").alias("_b"), "before", "_mix_rest")
    )
    inside = (
        rows.join(F.broadcast(edge), (F.col("_mix_pattern") == F.col("_p")) & (bucket == F.col("_b")))
        .groupBy("_mix_pattern", "before", "_mix_rest", "_mix_draw", "_mix_key").agg(F.sum("size").alias("words"))
    )
    order = Window.partitionBy("_mix_pattern").orderBy("_mix_draw", F.col("_mix_key").asc_nulls_first())
    past = F.col("before") + F.sum("words").over(order) - F.col("words")
    # A document goes in if that brings the pattern nearer to its share; this holds up to some point of the order.
    last = (
        inside.withColumn("goes_in", past * 2 + F.col("words") <= F.col("_mix_rest") * 2).where("goes_in")
        .groupBy("_mix_pattern").agg(F.max(F.struct("_mix_draw", "_mix_key")).alias("_mix_last"))
    )
    first_of_edge = edge.select(F.col("_p").alias("_mix_pattern"), F.call_function("shiftleft", F.col("_b"), F.lit(4 * (_DRAW_DIGITS - _BUCKET_DIGITS))).alias("_mix_edge"))
    # As many rows as patterns, which is at most MOST_PATTERNS.
    cuts = materialize(shares.join(first_of_edge, "_mix_pattern", "left").join(last, "_mix_pattern", "left"), "mix-cuts")

    cuts = cuts.select(F.col("_mix_pattern").alias(own_pattern), F.col("_mix_all").alias(own_all), F.col("_mix_edge").alias(own_edge), F.col("_mix_last").alias(own_last))
    own = F.struct(F.col(own_draw).alias("_mix_draw"), F.col(key).alias("_mix_key"))
    goes_in = (F.col(own_draw) < F.col(own_edge)) | (own <= F.col(own_last))
    n_copies = F.col(own_all) + F.coalesce(goes_in, F.lit(False)).cast("bigint")
    joined = drawn.withColumn(own_size, size).join(F.broadcast(cuts), own_pattern)
    added = [F.col(own_size).alias(size_name), (n_copies * F.col(own_size)).alias(taken_name)]
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], *added), sizes, wanted
