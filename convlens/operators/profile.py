"""Exploration tables: counts, crosstabs, summaries, histograms, bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convlens import constants as K
from convlens import session
from convlens.functions import columns as B
from convlens.operators import ranking


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Count and share of each value."""
    rows = df.filter(F.col(column).isNotNull()) if dropna else df
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def category_survey(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of every value of several columns in one pass: (column, value, n)."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(columns), "column", "value")
    return long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))


def category_sizes(survey: DataFrame) -> DataFrame:
    """Number of categories per surveyed column."""
    return survey.groupBy("column").agg(F.count("*").alias("n_categories"), F.sum("n").alias("n_rows"))


def crosstab(
    df: DataFrame, row: str, column: str, values: Sequence, percent: bool = False, dropna: bool = True
) -> DataFrame:
    """Counts of row by column values, or row percentages; '<NA>' groups unless dropped."""
    if dropna:
        df = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    else:
        df = df.withColumns({row: B.or_missing(F.col(row)), column: B.or_missing(F.col(column))})
    wide = df.groupBy(row).pivot(column, list(values)).count().na.fill(0)
    if not percent:
        return wide
    names = [str(v) for v in values]
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return wide.select(row, *[(100 * F.col(n) / total).alias(n) for n in names])


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values with their rank, ties by value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), column).limit(k)
    return top.withColumn(
        "rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), column))
    )


def describe(df: DataFrame, column: str, by: Sequence[str] = (), probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std, min, quantiles, max; one row per group.

    Quantiles are exact, selected inside the brackets of a sketch. The column may
    be derived from texts, so it is written once and then read in each pass.
    """
    held = session.stage(df.select(*by, column))
    return _described(held, column, by, probs, ranking.exact_quantiles(held, column, probs, by))


def _described(df: DataFrame, column: str, by: Sequence[str], probs: Sequence[float], found: DataFrame) -> DataFrame:
    stats = df.groupBy(*by).agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    if by:
        stats = ranking.join_null_safe(stats, found, by, "left").withColumnRenamed("q", "_q")
    else:
        stats = stats.withColumn("_q", found.select("q").scalar())
    return _spread(stats, by, probs)


def describe_values(df: DataFrame, column: str, by: Sequence[str] = (), probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """`describe` with quantiles found by distributed counting."""
    return _described(df, column, by, probs, ranking.quantiles(df, column, probs, by))


def _spread(stats: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    quantiles = [F.col("_q")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probs)]
    return stats.select(*by, "count", "mean", "std", "min", *quantiles, "max")


def describe_many(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Summaries of several numeric columns as rows (series, count, mean, ...)."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "series", "value")
    return describe(long, "value", ["series"])


def column_audit(df: DataFrame) -> DataFrame:
    """Type, nulls, percentage of nulls and distinct values of every column.

    Text is told apart by digest, so whole texts are not shuffled.
    """
    measures = []
    for f in df.schema.fields:
        value = F.md5(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        measures += [
            F.count_if(F.col(f.name).isNull()).alias(f"{f.name}_null"),
            F.count_distinct(value).alias(f"{f.name}_unique"),
        ]
    one = df.agg(F.count("*").alias("_rows"), *measures)
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"{f.name}_null").alias("n_null"),
            (100 * F.col(f"{f.name}_null") / F.col("_rows")).alias("pct_null"),
            F.col(f"{f.name}_unique").alias("n_unique"),
        )
        for f in df.schema.fields
    ]
    return one.select(F.inline(F.array(*rows)))


def below_quantile(df: DataFrame, column: str, q: float = 0.99, strict: bool = False, domain: str = "counts") -> DataFrame:
    """Rows up to (or strictly below) a quantile of the column.

    `domain` 'counts' suits lengths; 'values' suits any numeric column.
    """
    if domain == "counts":
        limit = df.agg(F.percentile(column, F.lit(q))).scalar()
    else:
        limit = ranking.quantiles(df, column, [q]).select(F.col("q")[0]).scalar()
    return df.filter(F.col(column) < limit) if strict else df.filter(F.col(column) <= limit)


def edges(df: DataFrame, column: str, bins: int = K.LENGTH_BINS, margin: float = K.LEFT_EDGE_MARGIN) -> list[float]:
    """Equal-width bin edges over the column's range, the first one lowered by the margin.

    Runs one aggregation: two numbers come back and become literals of the plan.
    """
    lo, hi = ranking.value_range(df, column)
    step = (hi - lo) / bins
    return [lo - margin, *[lo + i * step for i in range(1, bins)], hi]


def with_bin(df: DataFrame, column: str, limits: Sequence[float]) -> DataFrame:
    """Add the 1-based right-closed `bin` of the column (`lo < x <= hi`); null outside all bins."""
    return df.withColumn("bin", cut(F.col(column), limits))


def cut(x: Column, limits: Sequence[float], include_lowest: bool = False) -> Column:
    """Right-closed bin of x by fixed limits. A value equal to the lowest limit is outside unless included."""
    below = sum((F.coalesce((x > F.lit(v)).cast("int"), F.lit(0)) for v in limits), F.lit(0))
    if include_lowest:
        below = F.when(x == F.lit(limits[0]), 1).otherwise(below)
    return F.when(below.between(1, len(limits) - 1), below)


def bin_counts(df: DataFrame, column: str, limits: Sequence[float]) -> DataFrame:
    """Rows per bin."""
    placed = with_bin(df.select(column), column, limits)
    return placed.filter("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))


def bin_sufficiency(needed: DataFrame, available: DataFrame, bins: int = K.LENGTH_BINS) -> DataFrame:
    """Needed and available rows per bin, sufficiency and shortfall, for every bin."""
    spark = needed.sparkSession
    every = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    joined = every.join(needed.withColumnRenamed("n", "needed"), "bin", "left").join(
        available.withColumnRenamed("n", "available"), "bin", "left"
    ).na.fill(0, ["needed", "available"])
    return joined.withColumns(
        {
            "sufficient": F.col("available") >= F.col("needed"),
            "shortfall": B.clip(F.col("needed") - F.col("available"), lower=0),
        }
    )


def aligned_counts(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Counts of each value in two tables side by side; missing ones are 0."""
    left = a.groupBy(column).agg(F.count("*").alias("n_a"))
    right = b.groupBy(column).agg(F.count("*").alias("n_b"))
    return left.join(right, column, "full_outer").na.fill(0, ["n_a", "n_b"])


def histogram(df: DataFrame, column: str, lo: float, width: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Fixed-width histogram per group: bucket, count and density. The last bin is closed."""
    x = F.col(column)
    hi = lo + width * bins
    at = F.when(x == F.lit(hi), bins - 1).otherwise(F.floor((x - F.lit(lo)) / F.lit(width)))
    counts = (
        df.filter((x >= F.lit(lo)) & (x <= F.lit(hi)))
        .groupBy(*by, at.cast("int").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )
    if by:
        totals = counts.groupBy(*by).agg(F.sum("n").alias("_total"))
        counts = ranking.join_null_safe(counts, totals, by)
    else:
        counts = counts.withColumn("_total", counts.agg(F.sum("n")).scalar())
    return counts.withColumn("density", F.col("n") / (F.col("_total") * F.lit(width))).drop("_total")


def boxplot(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and outliers per group."""
    quartiles = describe(df, column, by).select(*by, "count", F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3"))
    values = df.groupBy(*by, column).agg(F.count("*").alias("_n"))
    joined = ranking.join_null_safe(values, quartiles, by)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(*by).agg(
        F.max("count").alias("n"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col(column))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(column))).alias("whisker_hi"),
        F.sum(F.when(~inside, F.col("_n")).otherwise(0)).alias("n_outliers"),
    )
