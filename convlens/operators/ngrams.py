"""Token and n-gram counts per class."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens import session
from convlens.functions import text as TX
from convlens.operators import ranking


#: N-grams that one summary of frequent items keeps, per class and task.
TRACKED = 10_000


def grams_of(df: DataFrame, tokens: Column, by: str, n: int = 1) -> DataFrame:
    """(class, gram): every n-gram of every text."""
    listed = df.select(by, TX.held(tokens).alias("_t"))
    return listed.select(by, F.explode(TX.ngrams(F.col("_t"), n)).alias("gram"))


def gram_counts(df: DataFrame, tokens: Column, by: str, n: int = 1) -> DataFrame:
    """Count of every n-gram per class: (class, gram, n)."""
    return grams_of(df, tokens, by, n).groupBy(by, "gram").agg(F.count("*").alias("n"))


def error_share(tracked: int) -> float:
    """What a summary may miss at most, as a share of all grams: 3.5 over its table's size."""
    return 3.5 / (1 << math.ceil(math.log2(tracked / 0.75)))


def _first(counts: DataFrame, by: str, k: int) -> DataFrame:
    best = Window.partitionBy(by).orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_grams(df: DataFrame, tokens: Column, by: str, n: int = 1, k: int = 25, tracked: int = TRACKED) -> DataFrame:
    """The k most frequent n-grams of each class with their rank, ties by n-gram.

    Mergeable summaries of frequent items name candidates; a second pass counts
    the candidates exactly, so a task gives up at most `tracked` rows a class. An
    n-gram above twice the summary's error is sure to be a candidate: where the
    k-th count of every class is above that, nothing can be missing. Where it is
    not, as with flat counts, all n-grams are counted.
    """
    grams = grams_of(df, tokens, by, n)
    summary = session.stage(grams.groupBy(by).agg(F.count("*").alias("_all"), F.expr(f"approx_top_k(gram, {tracked}, {tracked})").alias("_items")))
    known = session.stage(summary.select(by, F.explode("_items.item").alias("gram")))
    exact = session.stage(ranking.join_null_safe(grams, known, [by, "gram"]).groupBy(by, "gram").agg(F.count("*").alias("n")))
    top = _first(exact, by, k)
    last = top.groupBy(by).agg(F.min("n").alias("_last"), F.count("*").alias("_k"))
    sure = F.col("_last") > 2 * error_share(tracked) * F.col("_all")
    # Candidates that make up all n-grams leave nothing to miss.
    whole = F.col("_counted") == F.col("_all")
    counted = exact.groupBy(by).agg(F.sum("n").alias("_counted"))
    # A class whose summary kept nothing has no counts here, and proves nothing.
    state = ranking.join_null_safe(ranking.join_null_safe(summary, last, [by], "left"), counted, [by], "left")
    proven = ((F.col("_k") == k) & sure) | whole
    doubtful = state.filter(~F.coalesce(proven, F.lit(False))).limit(1).count()
    return _first(gram_counts(df, tokens, by, n), by, k) if doubtful else top


def side_by_side(lists: dict[str, DataFrame]) -> DataFrame:
    """Ranked lists as columns 'gram (n)' beside each other; shorter ones are padded with ''."""
    out = None
    for name, ranked in lists.items():
        shown = ranked.select("rank", F.format_string("%s (%d)", "gram", "n").alias(name))
        out = shown if out is None else out.join(shown, "rank", "full_outer")
    return out.na.fill("")


def vocabulary_size(df: DataFrame, text: str, by: str) -> DataFrame:
    """Number of distinct words per corpus."""
    words = df.select(by, F.explode(TX.words(F.col(text))).alias("word"))
    return words.groupBy(by).agg(F.count_distinct("word").alias("vocabulary"))
