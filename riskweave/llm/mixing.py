"""A mix of sources at target weights, from documents that may belong to several.

Documents are counted by membership pattern (the set of sources that hold
them). A minimum-cost flow sends the words of the patterns to the quotas of the
sources, where a second and third use of a word cost more than a first. What
the flow takes of a pattern is so many copies of all its documents and some
more of a part, which is chosen by a seeded hash of the documents.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from fractions import Fraction
from itertools import cycle
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.flow import route
from riskweave.session import settle

REPEATS = 3
EDGE_ROWS = 1 << 11      # documents that one task chooses from, about
EXPANDED = 1 << 16       # equal rows that one row of the plan stands for
BITS = 31


class Mix(NamedTuple):
    """``rows``: key, pattern, size, taken per document; ``sources``: source, source_size, target, routed."""

    rows: DataFrame
    sources: DataFrame


def shares(sizes: dict[str | None, int], weights: Sequence[int], repeats: int = REPEATS) -> dict[str | None, Fraction]:
    """The target of each source, exactly.

    Sources in the order of their code points, null last, weigh ``weights`` in
    turn and share the sum of ``sizes``; none gets more than ``repeats`` times its
    size, and what it can't take is shared again by weight.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(names, cycle(weights)))
    most = {s: Fraction(repeats * sizes[s]) for s in names}
    rest, open_, out = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        each = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if each * weight[s] > most[s]}
        for s in above or open_:
            out[s] = most[s] if above else each * weight[s]
        if not above:
            break
        rest -= sum(most[s] for s in above)
        open_ -= above
    return out


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _members(column: str, kind: str) -> Column:
    """The distinct sources of a document in order; none at all is the null source."""
    if not kind.startswith("array"):
        return F.array(F.col(column).cast("string"))
    some = F.array_sort(F.array_distinct(F.col(column).cast("array<string>")))
    return F.when(F.size(F.coalesce(some, F.array())) > 0, some).otherwise(F.array(F.lit(None).cast("string")))


def mix(docs: DataFrame, weights: Sequence[int], key: str = "doc_id", text: str = "text", source: str = "source",
        repeats: int = REPEATS, seed: int = 7) -> Mix:
    """Takes words of all documents so that each source comes near its target.

    ``source`` is a text, or an array of the sources that hold a document. Size is
    the number of words (null: 0). A document is taken as a whole, ``k`` or ``k + 1``
    times, ``repeats`` times at most; a source misses its target by less than half of
    the smallest document that could have been added. The same rows give the
    same result in any order and partitioning; of equal rows it is the number
    of those taken once more that is decided. A null or empty ``source`` is the
    null source; texts without words take nothing; an empty table gives none.
    The driver holds one row per pattern and source.
    """
    spark = docs.sparkSession
    kind = docs.schema[source].dataType.simpleString()
    key_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.to_json(_members(source, kind)).alias("pattern"), word_count(text).alias("size"))
    rows = rows.withColumn("__h", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key).cast("string"), "size"), 64 - BITS))
    rows = settle(rows, "mix-rows")

    totals = rows.groupBy("pattern").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).collect()     # one row per pattern
    patterns = sorted((t["pattern"], json.loads(t["pattern"]), t["words"], t["n"]) for t in totals)
    sizes: dict[str | None, int] = {}
    for _, members, words, _ in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + words
    targets = shares(sizes, weights, repeats)
    quotas = {s: round(t) for s, t in targets.items()}
    routed = route([(members, words) for _, members, words, _ in patterns], quotas, repeats)
    plan = []
    for (name, _, words, n), way in zip(patterns, routed):
        copies, rest = divmod(sum(way.values()), words) if words else (0, 0)
        plan.append((name, copies, rest, max(1, -(-n // EDGE_ROWS))))
    # written, so that its size is known and the rows need not move to meet it
    plan = settle(spark.createDataFrame(plan, "pattern string, __copies long, __rest long, __parts long"), "mix-plan")
    into = {s: sum(way.get(s, 0) for way in routed) for s in sizes}
    sources = settle(spark.createDataFrame([(s, sizes[s], float(targets[s]), into[s]) for s in sizes],
                                           "source string, source_size long, target double, routed long"), "mix-sources")

    # hashes are even, so a pattern's parts are; only the part where the sum is reached is looked at row by row
    placed = rows.join(plan, "pattern").withColumn("__part", F.shiftright(F.col("__h") * F.col("__parts"), BITS))
    parts = placed.groupBy("pattern", "__rest", "__part").agg(F.sum("size").alias("s"))
    upto = F.sum("s").over(Window.partitionBy("pattern").orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = (parts.withColumn("__upto", upto).filter("__upto - s < __rest AND __rest <= __upto")
             .select("pattern", F.col("__part").alias("__edge"), (F.col("__rest") - F.col("__upto") + F.col("s")).alias("__room")))
    placed = placed.join(settle(edges, "mix-edges"), "pattern", "left")
    more = F.coalesce(F.col("__part") < F.col("__edge"), F.lit(False)).cast("long")
    whole = placed.filter("__edge IS NULL OR __part <> __edge").select(
        key, "pattern", "size", (F.col("size") * (F.col("__copies") + more)).alias("taken"))

    edge = (placed.filter("__part = __edge").groupBy(key, "pattern", "size", "__h", "__copies", "__room")
            .agg(F.count(F.lit(1)).alias("__n")))
    picked = edge.groupBy("pattern").applyInArrow(
        _choose, f"`{key}` {key_type}, pattern string, size long, __copies long, __n long, __more long")
    counts = F.array(F.struct(F.col("__more").alias("n"), F.lit(1).cast("long").alias("more")),
                     F.struct((F.col("__n") - F.col("__more")).alias("n"), F.lit(0).cast("long").alias("more")))
    equal = picked.withColumn("__c", F.explode(counts)).filter("__c.n > 0").withColumn(
        "__b", F.explode(F.expr(f"sequence(0L, (__c.n - 1) div {EXPANDED})"))).repartition(F.xxhash64("pattern", key, "size", "__b"))
    equal = equal.withColumn("__i", F.explode(F.expr(f"sequence(1L, least({EXPANDED}L, __c.n - __b * {EXPANDED}))")))
    chosen = equal.select(key, "pattern", "size", (F.col("size") * (F.col("__copies") + F.col("__c.more"))).alias("taken"))
    return Mix(whole.unionByName(chosen), sources)


def _choose(part: pa.Table) -> pa.Table:
    """Goes through the documents in the order of their hashes and takes those that still fit.

    ``__more``: how many of the ``__n`` equal rows are taken once more. At the end
    the smallest one left is added if that brings the sum nearer.
    """
    key = part.column_names[0]
    part = part.sort_by([("__h", "ascending"), (key, "ascending"), ("size", "ascending")])
    sizes, counts = part["size"].to_pylist(), part["__n"].to_pylist()
    room = part["__room"][0].as_py()
    more = [0] * len(sizes)
    for i, size in enumerate(sizes):
        if not room:
            break
        if not size:
            continue
        more[i] = min(counts[i], room // sizes[i])
        room -= more[i] * sizes[i]
    left = min(((s, i) for i, s in enumerate(sizes) if s and more[i] < counts[i]), default=None)
    if room and left and left[0] - room < room:
        more[left[1]] += 1
    return part.select([key, "pattern", "size", "__copies", "__n"]).append_column("__more", pa.array(more, pa.int64()))

