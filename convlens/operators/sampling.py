"""Exact seeded samples, splits and ids. None depends on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens import constants as K
from convlens.operators import profile, ranking


def sample_exact(df: DataFrame, n: int, id_col: str, seed=K.SEED) -> DataFrame:
    """Exactly n rows (all, if there are fewer)."""
    return ranking.lowest_by_hash(df, n, id_col, seed=seed)


def shuffled(df: DataFrame, id_col: str, seed=K.SEED, name: str = "position") -> DataFrame:
    """Add each row's 1-based place in a seeded shuffle."""
    return ranking.hash_ranks(df, id_col, seed=seed, name=name)


def sample_balanced(df: DataFrame, n: int | Column, label: str, id_col: str, first=1, seed=K.SEED,
                    complete: bool = True) -> DataFrame:
    """n rows, half of each of two classes; the first class gets the odd row.

    A class that is short raises; without `complete` it gives all its rows.
    """
    total = n if isinstance(n, Column) else F.lit(n)
    half = F.floor(total / 2)
    quota = F.when(F.col(label) == first, half + total % 2).otherwise(half)
    if complete:
        sizes = df.groupBy(label).agg(F.count("*").alias("n")).withColumn("needed", quota)
        found = sizes.agg(F.count_if(F.col("n") < F.col("needed")).alias("short"), F.count("*").alias("classes")).first()
        if found.short or found.classes < 2:
            raise ValueError(f"a class of {label} has fewer rows than its half of the sample")
    return ranking.lowest_by_hash(df, quota, id_col, [label], seed)


def sample_per_group(df: DataFrame, n: int, group: str, id_col: str, seed=K.SEED, few_groups: bool = False) -> DataFrame:
    """n rows of every group (all of a smaller one)."""
    return ranking.lowest_by_hash(df, n, id_col, [group], seed, few_groups)


def sample_matched(target: DataFrame, pool: DataFrame, value: str, id_col: str, bins: int = K.LENGTH_BINS, seed=K.SEED) -> DataFrame:
    """Rows of the pool whose histogram of `value` equals the target's.

    Bins span the target's range. A bin that runs short gives all it has;
    `profile.bin_sufficiency` reports the shortfall.
    """
    limits = profile.edges(target, value, bins)
    needed = profile.bin_counts(target, value, limits).withColumnRenamed("n", "q1")
    placed = profile.with_bin(pool, value, limits).filter("bin is not null")
    return ranking.lowest_by_hash(placed, needed, id_col, ["bin"], seed)


def class_quotas(classes: DataFrame, label: str, draws: Column, name: str = "q1") -> DataFrame:
    """Share `draws` among classes in proportion to their size `n`, by largest remainder.

    `classes` has one row per class; ties go to the lower label. Adds the quota.
    """
    everyone = Window.partitionBy(F.lit(0))
    shared = classes.withColumn("_draws", draws).withColumn("_exact", F.col("_draws") * F.col("n") / F.sum("n").over(everyone))
    shared = shared.withColumn("_floor", F.floor("_exact"))
    rest = F.round(F.col("_exact") - F.col("_floor"), 9)
    place = F.row_number().over(everyone.orderBy(F.desc(rest), label))
    short = F.col("_draws") - F.sum("_floor").over(everyone)
    quota = F.col("_floor") + (place <= short).cast("int")
    return shared.withColumn(name, quota.cast("bigint")).drop("_draws", "_exact", "_floor")


def kept_of(held_out: float) -> Column:
    """Rows left when ceil(share * rows) are held out; over a class table."""
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return total - F.ceil(total * F.lit(held_out))


def stratified_split(df: DataFrame, label: str, id_col: str, held_out: float, names: tuple[str, str] = ("train", "val"), seed=K.SEED) -> DataFrame:
    """Add `split`: the held-out part takes ceil(share * rows), each class its exact quota."""
    parts = ranking.parts_by_hash(
        df, lambda classes: class_quotas(classes, label, kept_of(held_out)).drop("n"), id_col, [label], seed
    )
    return parts.withColumn("split", F.when(F.col("part") == 0, names[0]).otherwise(names[1])).drop("part")


def three_way_split(df: DataFrame, label: str, id_col: str, test: float = 0.2, val: float = 0.25, seed=K.SEED) -> DataFrame:
    """Add `split`: test takes its share of all rows, val its share of the rest, class by class."""

    def quotas(classes: DataFrame) -> DataFrame:
        rest = class_quotas(classes, label, kept_of(test), "q2").select(label, F.col("q2").alias("n"))
        both = class_quotas(rest, label, kept_of(val))
        return both.select(label, "q1", F.col("n").alias("q2"))

    parts = ranking.parts_by_hash(df, quotas, id_col, [label], seed)
    split = F.when(F.col("part") == 0, "train").when(F.col("part") == 1, "val").otherwise("test")
    return parts.withColumn("split", split).drop("part")


def learning_curve(df: DataFrame, label: str, id_col: str, sizes: Sequence[int], seed=K.SEED) -> DataFrame:
    """Rows of each stratified subset size, tagged with `size`; smaller ones are nested in larger.

    Every row is ranked once; a size at or above the table takes all of it.
    """
    classes = df.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    quotas = None
    for size in sizes:
        part = class_quotas(classes, label, F.least(F.lit(size).cast("bigint"), total)).drop("n").withColumn("size", F.lit(size))
        quotas = part if quotas is None else quotas.unionByName(part)
    ranked = ranking.hash_ranks(df, id_col, [label], seed, "_rank")
    joined = ranking.join_null_safe(ranked, F.broadcast(quotas), [label])
    return joined.filter(F.col("_rank") <= F.col("q1")).drop("_rank", "q1")


def assign_ids(df: DataFrame, order: str, name: str = "conversation_id", offset: Column | int = 0) -> DataFrame:
    """Add dense ids 0, 1, ... in the order of a unique numeric key, moved by the offset."""
    ranked = ranking.running_totals(df, [order], ranking.quantile_bucket(df, order), {name: F.lit(1).cast("bigint")})
    start = offset if isinstance(offset, Column) else F.lit(offset)
    return ranked.withColumn(name, F.col(name) - 1 + start)


def next_free_id(df: DataFrame, name: str = "conversation_id") -> Column:
    """Offset for ids that must not meet those of `df`."""
    return F.coalesce(df.agg(F.max(name) + 1).scalar(), F.lit(0))
