"""Global order without a one-task sort: buckets, prefix sums, order statistics.

A window without ``partitionBy`` sends every row to one task, and one keyed by
a hot group does nearly the same. The jobs here cut the ordered column into
ranges first. Cuts may be approximate: they only say which range a row sorts
in, and exact counts per range turn positions inside a range into positions in
the whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import settle

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096
CUT_SAMPLE = 100_000
_CHUNK = 64


def literal(value: Any) -> str:
    """SQL text of a plain value: long lists of literals are parsed at once."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else f"{value}L"


def count_at_or_below(column: str, edges: Sequence[Any]) -> Column:
    """How many of the sorted ``edges`` are <= the value of ``column``.

    For texts, and for few edges of other kinds; see ``with_buckets``.
    """
    if not edges:
        return F.lit(0)
    v, texts = f"`{column}`", [literal(e) for e in edges]
    if len(edges) <= 8:
        return F.expr(" + ".join(f"CAST({v} >= {e} AS INT)" for e in texts))
    chunks = [texts[i:i + _CHUNK] for i in range(0, len(texts), _CHUNK)]
    firsts = ", ".join(c[0] for c in chunks)
    lists = ", ".join(f"array({', '.join(c)})" for c in chunks)
    full = f"size(filter(array({firsts}), e -> {v} >= e))"
    inner = f"size(filter(get(array({lists}), {full} - 1), e -> {v} >= e))"
    return F.expr(f"CASE WHEN {full} = 0 THEN 0 ELSE ({full} - 1) * {_CHUNK} + {inner} END")


def with_buckets(df: DataFrame, edges: Mapping[str, Sequence[float]], prefix: str = "_bucket_") -> DataFrame:
    """Adds ``<prefix><i>`` per column: how many of its sorted edges are <= its value.

    A binary search per value; a sum of comparisons over many columns grows
    into methods the JVM does not compile.
    """
    columns = {}
    for i, (c, es) in enumerate(edges.items()):
        if len(es) < 1:
            columns[f"{prefix}{i}"] = F.when(F.col(c).isNotNull(), 0)
    searched = [(i, c, es) for i, (c, es) in enumerate(edges.items()) if len(es)]
    # adding zero turns a negative zero into zero, which the search tells apart
    df = df.withColumns({
        **columns, **{f"_in_{i}": F.col(c).cast("double") + F.lit(0.0) for i, c, _ in searched}})
    if not searched:
        return df
    inf = float("inf")
    search = Bucketizer(
        splitsArray=[[-inf, *[float(e) + 0.0 for e in es], inf] for _, _, es in searched],
        inputCols=[f"_in_{i}" for i, _, _ in searched],
        outputCols=[f"_out_{i}" for i, _, _ in searched], handleInvalid="keep")
    found = search.transform(df)
    return found.withColumns({
        f"{prefix}{i}": F.col(f"_out_{i}").cast("int") for i, _, _ in searched
    }).drop(*[f"_in_{i}" for i, _, _ in searched], *[f"_out_{i}" for i, _, _ in searched])


def cut_points(df: DataFrame, column: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list:
    """Values that cut ``column`` into ranges of about ``rows_per_bucket`` distinct values.

    At most ``MAX_BUCKETS`` ranges. The cuts come from a sample of the distinct
    values, so no task merges sketches of the whole and copies have no weight.
    """
    distinct = df.agg(F.approx_count_distinct(column)).first()[0]
    buckets = min(MAX_BUCKETS, -(-distinct // rows_per_bucket))
    values = _hash_sample(df, column, distinct) if buckets > 1 else []
    return sorted({values[i * len(values) // buckets] for i in range(1, buckets)}) if values else []


def _hash_sample(df: DataFrame, column: str, distinct: int) -> list:
    """About ``CUT_SAMPLE`` distinct values, sorted; copies collapse map-side."""
    every = max(1, distinct // CUT_SAMPLE)
    picked = df.filter(F.col(column).isNotNull() & (F.pmod(F.xxhash64(column), F.lit(every)) == 0))
    return sorted(r[0] for r in picked.select(column).distinct().collect())


def with_range(df: DataFrame, column: str, cuts: Sequence[Any]) -> DataFrame:
    """Adds ``_range``: the range between ``cuts`` that a row falls into."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn("_range", count_at_or_below(column, cuts))
    # whole numbers may share a double here; the ranges still follow their order
    distinct = sorted({float(c) for c in cuts})
    return with_buckets(df, {column: distinct}).withColumnRenamed("_bucket_0", "_range")


def prefix_sums(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    *,
    descending: bool = False,
    cuts: list | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Adds ``cum_<s>``: the sum of ``s`` up to and with this row within ``by``.

    Expects one row per ``(by, order)``, and ``df`` cheap to read twice (see
    ``settle``). A hot group is spread over the ranges between ``cuts``.
    """
    if cuts is None:
        cuts = cut_points(df, order, rows_per_bucket)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*by, "_range").orderBy(direction).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranged = with_range(df, order, cuts)
    local = ranged.select("*", *[F.sum(s).over(inside).alias(f"cum_{s}") for s in sums])
    if not cuts:
        return local.drop("_range")
    # one row per group and range from here: bounded by the number of cuts
    range_order = F.col("_range").desc() if descending else F.col("_range").asc()
    before = Window.partitionBy(*by).orderBy(range_order).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
        .select(*by, "_range", *[
            F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_c_{s}") for s in sums])
    )
    joined = join_null_safe(local, carried, [*by, "_range"])
    return joined.select(*df.columns, *[
        (F.col(f"cum_{s}") + F.col(f"_c_{s}")).alias(f"cum_{s}") for s in sums])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; keys are kept once."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(right, same, how).drop(*[f"_right_{k}" for k in keys])


def order_statistics(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    ranks_of: Callable[[int], Sequence[int]],
    accuracy: int = 2_000,
) -> tuple[int, dict[str, tuple[int, dict[int, tuple[Any, int]]]]]:
    """Exact values at 0-based ranks of several columns in two passes.

    ``fractions`` say roughly where the ranks lie. Pass 1 sketches a narrow
    bracket round each; pass 2 counts the rows between brackets and keeps the
    distinct values only inside them (about ``4/accuracy`` of the rows each),
    so little is shuffled. A finer sketch narrows the brackets but makes each
    task's sketch, which one task merges, larger. A bracket that misses its rank is widened, in the end
    to the whole range.

    Returns the row count and ``{column: (non-null rows, {rank: (value, rows
    below value)})}``.
    """
    rows = 0
    done: dict[str, tuple[int, dict[int, tuple[Any, int]]]] = {}
    todo, slack = list(columns), 2.0
    while todo:
        reach = slack / accuracy
        probs = [p for f in fractions for p in (max(0.0, f - reach), min(1.0, f + reach))]
        array = ", ".join(f"{p!r}D" for p in probs)
        sketch = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[f(c).alias(f"{name}_{i}") for i, c in enumerate(todo) for name, f in (("lo", F.min), ("hi", F.max))],
            *[F.count(c).alias(f"n_{i}") for i, c in enumerate(todo)],
            *[F.expr(f"percentile_approx(`{c}`, array({array}), {accuracy})").alias(f"q_{i}")
              for i, c in enumerate(todo)],
        ).first()
        rows, brackets = sketch["rows"], {}
        for i, c in enumerate(todo):
            if sketch[f"n_{i}"] == 0:
                done[c] = (0, {})
            else:
                q = sketch[f"q_{i}"]
                pairs = zip(q[::2], q[1::2]) if reach < 1 else [(sketch[f"lo_{i}"], sketch[f"hi_{i}"])]
                brackets[c] = _merge(sorted(pairs))
        if not brackets:
            break
        picked = _inside_brackets(df, brackets, {
            c: (sketch[f"n_{i}"], ranks_of(sketch[f"n_{i}"])) for i, c in enumerate(todo) if c in brackets})
        for c, found in picked.items():
            n = sketch[f"n_{todo.index(c)}"]
            if set(ranks_of(n)) <= set(found):
                done[c] = (n, found)
        todo = [c for c in todo if c not in done]
        slack *= 50
    return rows, done


def _merge(pairs: list[tuple]) -> list[tuple]:
    merged: list[tuple] = []
    for lo, hi in pairs:
        if merged and lo <= math.nextafter(merged[-1][1], math.inf):
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def _inside_brackets(df, brackets, wanted):
    """Values at the wanted ranks of each column, where a bracket holds them."""
    names = list(brackets)
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in names)
    kind = "BIGINT" if whole else "DOUBLE"
    # odd cells are brackets, even cells lie between them
    if whole:
        cells = [
            " + ".join(f"CAST(`{c}` >= {literal(lo)} AS INT) + CAST(`{c}` > {literal(hi)} AS INT)"
                       for lo, hi in brackets[c]) for c in names]
        long = df.select(*names).selectExpr(*[f"`{c}`" for c in names], *[f"{e} AS _{i}" for i, e in enumerate(cells)])
    else:
        long = with_buckets(df.select(*names), {
            c: [e for lo, hi in brackets[c] for e in (lo, math.nextafter(hi, math.inf))] for c in names}, "_")
    rows = ", ".join(
        f"named_struct('col', {i}, 'cell', _{i}, 'v', CASE WHEN _{i} % 2 = 1 THEN CAST(`{c}` AS {kind}) END)"
        for i, c in enumerate(names))
    counts = settle(
        long.selectExpr(f"inline(array({rows}))").filter(F.col("cell").isNotNull())
        .groupBy("col", "cell", "v").agg(F.count(F.lit(1)).alias("n")), "brackets")

    start_of, targets, at = {}, [], [0] * len(names)
    totals = counts.groupBy("col", "cell").agg(F.sum("n").alias("n")).collect()
    for i, cell, n in sorted(tuple(r) for r in totals):
        if cell % 2 == 1:
            start_of[i, cell] = at[i]
            targets += [(i, cell, k - at[i]) for k in wanted[names[i]][1] if at[i] <= k < at[i] + n]
        at[i] += n

    result: dict[str, dict[int, tuple[Any, int]]] = {c: {} for c in names}
    if not targets:
        return result
    held = sum(n for _, cell, n in totals if cell % 2 == 1)
    inside = prefix_sums(
        counts.filter(F.col("cell") % 2 == 1), ["col", "cell"], "v", ["n"],
        cuts=[] if held <= ROWS_PER_BUCKET else None).withColumnRenamed("cum_n", "upto")
    hit = F.expr(" OR ".join(
        f"(col = {i} AND cell = {cell} AND upto > {k} AND upto - n <= {k})" for i, cell, k in targets))
    for r in inside.filter(hit).collect():
        c, end = names[r["col"]], start_of[r["col"], r["cell"]] + r["upto"]
        for k in wanted[c][1]:
            if end - r["n"] <= k < end:
                result[c][k] = (r["v"], end - r["n"])
    return result


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[tuple[int, int]],
) -> dict[str, tuple[int, list[float | None]]]:
    """``{column: (non-null rows, quantiles)}``, see ``counted_quantiles``."""
    return counted_quantiles(df, columns, fractions)[1]


def counted_quantiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[tuple[int, int]],
) -> tuple[int, dict[str, tuple[int, list[float | None]]]]:
    """Row count and linearly interpolated quantiles at ``num/den`` positions,
    which are found in whole-number steps."""
    def ranks(n: int) -> list[int]:
        lows = [num * (n - 1) // den for num, den in fractions]
        return sorted({k for low in lows for k in (low, min(low + 1, n - 1))})

    out: dict[str, tuple[int, list[float | None]]] = {}
    rows, found = order_statistics(df, columns, [a / b for a, b in fractions], ranks)
    for c, (n, at) in found.items():
        values: list[float | None] = []
        for num, den in fractions:
            if n == 0:
                values.append(None)
                continue
            low, rest = divmod(num * (n - 1), den)
            a, b = float(at[low][0]), float(at[min(low + 1, n - 1)][0])
            values.append(a + (b - a) * (rest / den))
        out[c] = (n, values)
    return rows, out


def kth_text(df: DataFrame, column: str, k: int) -> str:
    """The value at 0-based rank ``k`` of a text column, copies counted.

    Each round cuts the rest into ranges at sampled values, counts the ranges
    exactly and goes on inside the one that holds the rank.
    """
    rest = df.select(column)
    while True:
        distinct = rest.agg(F.approx_count_distinct(column)).first()[0]
        if distinct <= CUT_SAMPLE:
            for value, n in sorted(tuple(r) for r in rest.groupBy(column).count().collect()):
                if k < n:
                    return value
                k -= n
            raise IndexError("rank beyond the number of rows")
        sample = _hash_sample(rest, column, distinct)
        edges = sorted({sample[i * len(sample) // 1024] for i in range(1, 1024)}) if sample else []
        ranges = rest.groupBy(count_at_or_below(column, edges).alias("range")).count()
        for r, n in sorted(tuple(x) for x in ranges.collect()):
            if k < n:
                break
            k -= n
        else:
            raise IndexError("rank beyond the number of rows")
        if r > 0:
            rest = rest.filter(F.col(column) >= edges[r - 1])
        if r < len(edges):
            rest = rest.filter(F.col(column) < edges[r])


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, shards: int = 64,
) -> DataFrame:
    """The first ``k`` rows per group with their ``row_no``.

    Each group is first cut to ``k`` rows in every shard, so the final ranking
    sees at most ``shards * k`` rows of a group, however large it is. A shard is
    a set of input partitions: a map task has rows of one shard, which the
    optimizer cuts to ``k`` per group before the shuffle where its limit
    (``windowGroupLimitThreshold``, the caller's) admits ``k``.
    """
    shard = F.pmod(F.spark_partition_id(), F.lit(shards))
    first = Window.partitionBy(*by, "_shard").orderBy(*order)
    last = Window.partitionBy(*by).orderBy(*order)
    return (
        df.withColumn("_shard", shard)
        .withColumn("row_no", F.row_number().over(first)).filter(F.col("row_no") <= k)
        .drop("_shard", "row_no")
        .withColumn("row_no", F.row_number().over(last)).filter(F.col("row_no") <= k)
    )
