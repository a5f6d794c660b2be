"""Bootstrap confidence intervals by Poisson resampling of counted cells.

Drawing each row a Poisson(1) number of times resamples the table. Rows that
agree on all a metric looks at form one cell, and a sum of Poisson(1) draws is
one Poisson(n) draw, so a cell of any size costs one draw per replicate.

A draw is the inverse distribution function at a digest of seed, cell and
replicate: the same on every engine and partitioning. A cell carries its draws as
one array, made where the cell's bucket is worked on; what is shuffled are the
cells, and one row per bucket and replicate.
"""

from __future__ import annotations

import json
import math
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.operators import metrics, ranking
from convlens.operators.embeddings import let

#: Cells up to this size are drawn from the exact distribution, larger ones from its normal expansion.
EXACT = 32
#: Cells of one bucket: its task sorts as many rows per replicate.
CELLS = 1 << 12


def distribution(n: int) -> list[float]:
    """P(X <= k) of a Poisson(n) variable for k = 0, 1, ..., as far as a double tells it from 1."""
    p = total = math.exp(-n)
    out = [total]
    while total < 1 - 1e-15 and len(out) < n + 12 * math.sqrt(n) + 20:
        p *= n / len(out)
        total += p
        out.append(total)
    return out


def distributions() -> list[list[float]]:
    return [distribution(n) for n in range(1, EXACT + 1)]


def draws(key: Column, n: Column, replicates: int, seed: int = 0) -> Column:
    """Array of Poisson(n) draws of a cell, one per replicate; 0 where the cell is empty."""
    known = F.from_json(F.lit(json.dumps(distributions())), "array<array<double>>")

    def part(digest: Column, at: int) -> Column:
        return (F.conv(F.substring(digest, at, 12), 16, 10).cast("bigint") + 0.5) / float(1 << 48)

    def drawn(digest: Column) -> Column:
        exact = let(part(digest, 1), lambda u: F.size(F.filter(F.get(known, n.cast("int") - 1), lambda c: c <= u)))
        normal = F.sqrt(-2 * F.ln(part(digest, 1))) * F.cos(F.lit(2 * math.pi) * part(digest, 13))
        wide = let(normal, lambda z: F.greatest(F.floor(n + F.sqrt(n) * z + (z * z - 1) / 6 + 0.5), F.lit(0).cast("bigint")))
        return F.when(n == 0, F.lit(0).cast("bigint")).when(n <= EXACT, exact.cast("bigint")).otherwise(wide)

    def one(replicate: Column) -> Column:
        return let(F.md5(F.concat_ws("|", F.lit(str(seed)), key, replicate.cast("string"))), drawn)

    return F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)), one)


def _interval(values: DataFrame, metric: str, ci: float) -> DataFrame:
    tail = (1 - ci) / 2
    ends = F.percentile(metric, F.array(F.lit(tail), F.lit(1 - tail)))
    return values.agg(ends.alias("_q"), F.count(metric).alias("replicates")).select(
        F.lit(metric).alias("metric"), F.col("_q")[0].alias("lo"), F.col("_q")[1].alias("hi"), "replicates"
    )


def _number(column: str) -> Column:
    return F.format_string("%.9f", F.col(column).cast("double"))


def f1_macro_interval(df: DataFrame, label: str, pred: str, replicates: int = 1000, ci: float = 0.95, seed: int = 0) -> DataFrame:
    """Interval of macro F1 over four cells."""
    cells = df.groupBy(F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    key = F.concat_ws("|", F.lit("cell"), F.col("y").cast("string"), F.col("p").cast("string"))
    drawn = cells.select("y", "p", F.posexplode(draws(key, F.col("n"), replicates, seed)).alias("replicate", "w"))
    y, p, w = F.col("y"), F.col("p"), F.col("w")

    def total(a, b):
        return F.sum(F.when((y == a) & (p == b), w).otherwise(0))

    counts = drawn.groupBy("replicate").agg(
        total(0, 0).alias("tn"), total(0, 1).alias("fp"), total(1, 0).alias("fn"), total(1, 1).alias("tp")
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    f1 = (metrics.ratio(2 * tp, 2 * tp + fp + fn) + metrics.ratio(2 * tn, 2 * tn + fp + fn)) / 2
    return _interval(counts.select(f1.alias("f1_macro")), "f1_macro", ci)


def roc_auc_replicates(df: DataFrame, label: str, score: str, replicates: int = 1000, seed: int = 0, bound: int = CELLS) -> DataFrame:
    """(replicate, roc_auc); null where a replicate drew one class only.

    Scores lie in order-keeping buckets. Inside a bucket the draws run down the
    scores; buckets are then put together by their totals.
    """
    cells = df.groupBy(F.col(score).alias("s")).agg(
        F.sum(label).cast("bigint").alias("pos"), F.sum(1 - F.col(label)).cast("bigint").alias("neg")
    )
    placed = cells.select("*", ranking.quantile_bucket(cells, "s", bound).alias("bucket")).repartition("bucket")
    pos, neg = (draws(F.concat_ws("|", _number("s"), F.lit(c)), F.col(n), replicates, seed) for c, n in (("1", "pos"), ("0", "neg")))
    each = placed.select("bucket", "s", F.posexplode(F.arrays_zip(pos.alias("p"), neg.alias("n"))).alias("replicate", "_w"))
    # The bucket decides where a row lies already, so this window sorts and does not shuffle.
    down = Window.partitionBy("bucket", "replicate").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    run = each.select("bucket", "replicate", F.col("_w.p").alias("p"), F.col("_w.n").alias("n"), F.sum("_w.p").over(down).alias("tp"))
    parts = run.groupBy("bucket", "replicate").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum(F.col("n") * (2 * F.col("tp") - F.col("p")) / 2).alias("area")
    )
    above = Window.partitionBy("replicate").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    met = parts.withColumn("area", F.col("area") + F.col("n") * F.coalesce(F.sum("p").over(above), F.lit(0)))
    both = (F.sum("p") > 0) & (F.sum("n") > 0)
    return met.groupBy("replicate").agg(F.when(both, F.sum("area") / (F.sum("p") * F.sum("n"))).alias("roc_auc"))


def roc_auc_interval(df: DataFrame, label: str, score: str, replicates: int = 1000, ci: float = 0.95, seed: int = 0) -> DataFrame:
    """Interval of ROC-AUC; cells are the distinct (score, label) pairs."""
    return _interval(roc_auc_replicates(df, label, score, replicates, seed), "roc_auc", ci)
