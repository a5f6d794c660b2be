"""Exact ranks and running totals without a single-task window.

Rows are spread over buckets that keep the order. Bucket totals are tiny, so
their running sum gives each bucket's offset; inside a bucket an ordinary
window finishes the job. No task sees more than one bucket of one group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens import constants as K
from convlens import session

HASH_DIGITS = 4
HASH_BUCKETS = 16**HASH_DIGITS


def seeded_key(id_col: Column, seed=K.SEED) -> Column:
    """Order-free random key of a row: the same on every engine and partitioning."""
    return F.md5(F.concat_ws("|", id_col.cast("string"), F.lit(str(seed))))


def hash_bucket(key: Column) -> Column:
    """Leading hex digits of a seeded key as a number; keeps the key's order."""
    return F.conv(F.substring(key, 1, HASH_DIGITS), 16, 10).cast("int")


#: Rows that one window of an order structure sees at most, unless they are equal.
BOUND = 1 << 20
#: Pieces that a bucket above the bound is cut into in one round.
FAN = 128
#: More limits than this are searched in an array, not by nested conditions.
NESTED = 128


def limits_bucket(value: Column, limits: Sequence[float]) -> Column:
    """How many of the ascending limits lie at or below a value: a search by halves, null below all."""
    if not limits:
        return F.lit(0)
    if len(limits) <= NESTED:

        def tree(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(value >= F.lit(limits[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

        return tree(0, len(limits))
    listed = F.split(F.lit(",".join(repr(float(x)) for x in limits)), ",").cast("array<double>")
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(len(limits).bit_length()))])

    def further(found: Column, step: Column) -> Column:
        at = found + step
        return F.when((at <= len(limits)) & (F.get(listed, at - 1) <= value), at).otherwise(found)

    return F.coalesce(F.aggregate(halves, F.lit(0), further), F.lit(0))


def splitters(df: DataFrame, column: str, bound: int = BOUND) -> list[float]:
    """Ascending limits between which no more than `bound` rows lie, or rows of one value only.

    A tree grown level by level: each round counts all buckets and cuts those
    above the bound at quantiles of their own, wherever they lie. A value that
    would fill a bucket by itself gets one of its own. The limits reach the
    driver, a few for every `bound` rows.
    """
    values = df.select(F.col(column).cast("double").alias("x"))
    limits: list[float] = []
    while True:
        placed = values.withColumn("b", limits_bucket(F.col("x"), limits))
        sizes = placed.groupBy("b").agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        big = {r["b"]: r for r in sizes.filter((F.col("n") > bound) & (F.col("lo") < F.col("hi"))).collect()}
        if not big:
            return limits
        shares = [i / FAN for i in range(1, FAN)]
        inside = placed.filter(F.col("b").isin(list(big)) if len(big) <= NESTED else F.array_contains(
            F.split(F.lit(",".join(map(str, big))), ",").cast("array<int>"), F.col("b")))
        cuts = inside.groupBy("b").agg(F.percentile_approx("x", shares, FAN * 40).alias("q")).collect()
        new = set()
        for r in cuts:
            own, q = big[r["b"]], [x for x in r["q"] if x == x]
            every = max(1, FAN * bound // (2 * own["n"]))
            new |= set(q[every - 1 :: every])
            hot = {a for a, z in zip(q, q[1:]) if a == z} | {own["lo"]} & set(q)
            new |= hot | {math.nextafter(x, math.inf) for x in hot}
        grown = sorted(set(limits) | new)
        if grown == limits:
            return limits
        limits = grown


def quantile_bucket(df: DataFrame, column: str, bound: int = BOUND) -> Column:
    """Order-keeping bucket of a numeric column; none holds more than `bound` rows unless their values are equal.

    Count equal values first where they may be many, or give them a second key by `tie_bucket`.
    """
    return limits_bucket(F.col(column).cast("double"), splitters(df, column, bound))


def tie_bucket(df: DataFrame, column: str, tie: str, bound: int = BOUND) -> Column:
    """Order-keeping bucket of (column, tie): a value of the first that exceeds the bound is cut along the second."""
    limits = splitters(df, column, bound)
    first = limits_bucket(F.col(column).cast("double"), limits)
    sizes = df.groupBy(first.alias("b")).agg(F.count("*").alias("n")).filter(F.col("n") > bound)
    second = F.lit(0)
    for r in sizes.collect():  # values of more than `bound` rows
        own = splitters(df.filter(first == r["b"]), tie, bound)
        second = F.when(first == r["b"], limits_bucket(F.col(tie).cast("double"), own)).otherwise(second)
    return F.struct(first.alias("a"), second.alias("b"))


def value_range(df: DataFrame, column: str) -> tuple[float, float]:
    """Smallest and largest value of a column: one aggregation, two numbers."""
    lo, hi = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    return (0.0, 0.0) if lo is None else (lo, hi)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys that may be null, keeping the left side's keys once."""
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    bucket: Column,
    measures: dict[str, Column],
    by: Sequence[str] = (),
    totals_as: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums of the measures along the order, per group.

    `totals_as` names extra columns for the group totals of measures; they come
    with the bucket offsets, so a hot group is not brought together for them.

    `bucket` must not decrease along the order. Rows that tie on the order get
    their totals in any sequence, so group ties first where that matters.
    """
    by = list(by)
    key = F.struct(*by, bucket.alias("_bucket"))
    spread = df.withColumns({"_k": key, **{f"_m_{n}": m for n, m in measures.items()}})
    totals = spread.groupBy("_k").agg(*[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in measures])
    before = (
        Window.partitionBy(*([F.col(f"_k.{c}") for c in by] or [F.lit(0)]))
        .orderBy("_k._bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*([F.col(f"_k.{c}") for c in by] or [F.lit(0)]))
    ends = [F.sum(f"_t_{n}").over(whole).alias(name) for n, name in (totals_as or {}).items()]
    offsets = totals.select(
        "_k", *ends, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in measures]
    )
    inside = Window.partitionBy("_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = spread.withColumns({f"_l_{n}": F.sum(f"_m_{n}").over(inside) for n in measures})
    # One key column for window and join: rows move once, and null groups meet.
    joined = local.join(offsets, "_k")
    return joined.withColumns({n: F.col(f"_l_{n}") + F.col(f"_o_{n}") for n in measures}).drop(
        "_k", *[f"{p}{n}" for n in measures for p in ("_m_", "_l_", "_o_")]
    )


def hash_ranks(df: DataFrame, id_col: str, by: Sequence[str] = (), seed=K.SEED, name: str = "rank") -> DataFrame:
    """Add the exact 1-based rank of each row in seeded random order, per group."""
    keyed = df.withColumn("_key", seeded_key(F.col(id_col), seed))
    ranked = running_totals(
        keyed, ["_key", id_col], hash_bucket(F.col("_key")), {name: F.lit(1).cast("bigint")}, by
    )
    return ranked.drop("_key")


Quota = DataFrame | Column | int


def parts_by_hash(
    df: DataFrame,
    quotas: Sequence[Column | int] | DataFrame | Callable[[DataFrame], DataFrame],
    id_col: str,
    by: Sequence[str] = (),
    seed=K.SEED,
    name: str = "part",
    few_groups: bool = False,
) -> DataFrame:
    """Cut each group, in seeded random order, at exact cumulative sizes.

    Adds the number of cut sizes a row lies beyond: 0 for the first part. Sizes
    are numbers or expressions over the group columns, or a table with the
    group columns and `q1`, `q2`, ... (or a function giving that table from the
    group sizes `n`).

    A histogram of hash buckets shows in which bucket of a group each size is
    reached. Rows of other buckets are decided without being moved; only the
    boundary buckets, one part in 65,536 each, are ranked. With `few_groups`
    the one-row-per-group cut table is broadcast: state it for label and bin
    columns only, otherwise Spark measures and decides.
    """
    by = list(by)
    keyed = df.withColumn("_key", seeded_key(F.col(id_col), seed))
    keyed = keyed.withColumn("_bucket", hash_bucket(F.col("_key")))
    counts = keyed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket")
    filled = counts.withColumn("_cum", F.sum("_n").over(upto))
    if callable(quotas):
        quotas = quotas(counts.groupBy(*by).agg(F.sum("_n").alias("n")))
    if isinstance(quotas, DataFrame):
        cuts = len(quotas.columns) - len(by)
        filled = join_null_safe(filled, F.broadcast(quotas) if few_groups else quotas, by)
    else:
        cuts = len(quotas)
        sizes = [q if isinstance(q, Column) else F.lit(q) for q in quotas]
        filled = filled.withColumns({f"q{j + 1}": q.cast("bigint") for j, q in enumerate(sizes)})
    found = []
    for j in range(1, cuts + 1):
        q = F.col(f"q{j}")
        cut = F.coalesce(F.min(F.when(F.col("_cum") >= q, F.col("_bucket"))), F.lit(HASH_BUCKETS))
        passed = F.coalesce(F.max(F.when(F.col("_cum") < q, F.col("_cum"))), F.lit(0))
        found += [cut.alias(f"_cut{j}"), (F.max(q) - passed).alias(f"_left{j}")]
    table = filled.groupBy(*by).agg(*found)
    if by:
        marked = join_null_safe(keyed, F.broadcast(table) if few_groups else table, by)
    else:
        one = table.select(F.struct(*table.columns)).scalar()
        marked = keyed.withColumns({c: one[c] for c in table.columns})
    bucket = F.col("_bucket")
    pairs = [(F.col(f"_cut{j}"), F.col(f"_left{j}")) for j in range(1, cuts + 1)]
    at_edge = F.lit(False)
    for cut, _ in pairs:
        at_edge = at_edge | (bucket == cut)
    clear = marked.filter(~at_edge).withColumn(name, sum((bucket > cut).cast("int") for cut, _ in pairs))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_key", id_col)
    edge = marked.filter(at_edge).withColumn("_place", F.row_number().over(inside))
    beyond = [((bucket > cut) | ((bucket == cut) & (F.col("_place") > left))).cast("int") for cut, left in pairs]
    edge = edge.withColumn(name, sum(beyond)).drop("_place")
    return clear.unionByName(edge).drop("_key", "_bucket", *table.columns[len(by):])


def lowest_by_hash(
    df: DataFrame,
    quota: Quota,
    id_col: str,
    by: Sequence[str] = (),
    seed=K.SEED,
    few_groups: bool = False,
) -> DataFrame:
    """Exactly `quota` rows per group: those lowest in seeded random order.

    A group smaller than its quota gives all its rows; a group missing from a
    quota table gives none.
    """
    sizes = quota if isinstance(quota, DataFrame) else [quota]
    return parts_by_hash(df, sizes, id_col, by, seed, "_part", few_groups=few_groups).filter("_part = 0").drop("_part")


def quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated quantiles of a column with any number of distinct values.

    One row per group with `q` as an array in the order of `probs`. Values are
    counted first, so a hot value is one row; their running counts come from
    `running_totals`.
    """
    by = list(by)
    known = df.filter(F.col(column).isNotNull())
    counts = known.groupBy(*by, column).agg(F.count("*").alias("_n"))
    cum = running_totals(
        counts, [column], quantile_bucket(counts, column), {"_cum": F.col("_n")}, by, {"_cum": "_total"}
    )
    start = F.col("_cum") - F.col("_n")
    picks = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (start <= at) & (at < F.col("_cum"))
            picks.append(F.max(F.when(hit, F.col(column).cast("double"))).alias(f"_{side}{i}"))
    found = cum.groupBy(*by).agg(F.max("_total").alias("_total"), *picks)
    values = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        part = pos - F.floor(pos)
        values.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * part)
    return found.select(*by, F.array(*values).alias("q"))


#: Entries of the quantile sketch: a bracket holds some six parts in `ACCURACY` of a group's rows.
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """Exact interpolated quantiles per group in two passes: (group, q), in the order of `probs`.

    A mergeable sketch brackets each wanted rank from both sides, wider than its
    error. The second pass counts what lies below a bracket and on its ends, and
    keeps the few values strictly inside; the rank is then picked exactly. Memory
    follows the sketch and the brackets, not the distinct values; a hot value is
    a bracket's end. One row per group leaves each task.
    """
    by, probs = list(by), [float(p) for p in probs]
    known = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_x"))
    reach = 2.0 / accuracy
    at = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    sketch = known.groupBy(*by).agg(F.count("*").alias("_n"), F.percentile_approx("_x", at, accuracy).alias("_b"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    sketch = session.stage(sketch)
    if by:
        met = join_null_safe(known, sketch, by)
    else:
        one = sketch.select(F.struct("_n", "_b", "_lo", "_hi")).scalar()
        met = known.withColumns({c: one[c] for c in ("_n", "_b", "_lo", "_hi")})
    x, found, kept = F.col("_x"), [], []
    for i, p in enumerate(probs):
        # The ends of the table stand in where a bracket would have to reach beyond it.
        lo = F.col("_lo") if p <= reach else F.get("_b", F.lit(2 * i))
        hi = F.col("_hi") if p >= 1 - reach else F.get("_b", F.lit(2 * i + 1))
        kept += [lo.alias(f"_lo{i}"), hi.alias(f"_hi{i}")]
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        found += [
            F.count_if(x < lo).alias(f"_below{i}"), F.count_if(x == lo).alias(f"_at{i}"),
            F.array_sort(F.collect_list(F.when((x > lo) & (x < hi), x))).alias(f"_in{i}"),
            F.count_if((x == hi) & (lo != hi)).alias(f"_end{i}"),
            F.any_value(lo).alias(f"_lo{i}"), F.any_value(hi).alias(f"_hi{i}"),
            # A rank may lie one place outside its bracket where a group is small.
            F.max(F.when(x < lo, x)).alias(f"_before{i}"), F.min(F.when(x > hi, x)).alias(f"_after{i}"),
        ]
    ready = met.select(*by, "_x", "_n", *kept).groupBy(*by).agg(F.any_value("_n").alias("_n"), *found)
    values = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_n") - 1)

        def value(rank: Column, i: int = i) -> Column:
            inside = rank - F.col(f"_below{i}") - F.col(f"_at{i}")
            beyond = inside - F.size(f"_in{i}") - F.col(f"_end{i}")
            return (
                F.when(rank < F.col(f"_below{i}"), F.col(f"_before{i}")).when(inside < 0, F.col(f"_lo{i}"))
                .when(beyond >= 0, F.col(f"_after{i}")).otherwise(F.coalesce(F.get(f"_in{i}", inside.cast("int")), F.col(f"_hi{i}")))
            )

        low, high = value(F.floor(pos)), value(F.ceil(pos))
        values.append(low + (high - low) * (pos - F.floor(pos)))
    return ready.select(*by, F.array(*values).alias("q"))
