"""Sources mixed at tempered shares, realised as whole passes and one partial pass per source.

A source's weight is its token share to a power, normalised. The power is found
by bisection: the smallest that keeps the weights' entropy, or the most repeated
source, within its target. A source's documents stand in a permutation given by
a hash of their ids, cut into blocks. Its token budget is met by whole passes
over the permutation, then by whole blocks from its start, and in the block
where the budget ends by single documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.session import stage

#: Hex digits of a document's place in the permutation, and of its block at each refinement.
PLACE_DIGITS, BLOCK_DIGITS = 12, 3
#: Exponents tried together in one pass over the source totals.
TRIES = 16
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str) -> Column:
    """Words of a whole text; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def place(id_col: str, seed: int) -> Column:
    """A document's place in its source's permutation: the same on every run and partitioning."""
    key = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, PLACE_DIGITS), 16, 10).cast("bigint")


def _measure(name: str, exponent: float) -> Column:
    """Entropy of the tempered weights in bits, or the repetitions of the most repeated source."""
    powered = F.pow("_share", F.lit(exponent))
    if name == "entropy":
        z = F.sum(powered)
        return F.log2(z) - F.sum(powered * F.log2(powered)) / z
    return F.pow(F.max("_share") / F.min("_share"), F.lit(1 - exponent))


def bisect_exponent(shares: DataFrame, target_entropy: float | None, max_repetition: float | None) -> float:
    """The smallest exponent in [0, 1] with entropy or repetition no higher than its target.

    Both fall as the exponent grows. If even 1 lies above the target, 1 is used:
    the sources' own shares. Each pass over the source totals tries several
    exponents; only their values reach the driver.
    """
    name, target = ("entropy", target_entropy) if target_entropy is not None else ("repetition", max_repetition)
    if target is None:
        raise ValueError("give target_entropy or max_repetition")
    low, high = 0.0, 1.0
    while high - low > 1e-12:
        tries = [low + (high - low) * i / TRIES for i in range(TRIES)]
        values = shares.agg(*[_measure(name, a).alias(f"v{i}") for i, a in enumerate(tries)]).first()
        if values[0] is None:
            return 1.0
        fits = [i for i, v in enumerate(values) if v <= target + 1e-12]
        if fits and fits[0] == 0:
            return tries[0]
        first = fits[0] if fits else TRIES
        low, high = tries[first - 1], tries[first] if first < TRIES else high
    return high


def plan(
    rows: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, budget: float | None = None
) -> DataFrame:
    """One row per source: weight, repetition, whole passes, and tokens of the partial pass.

    `rows` has `_source` and `_tokens`. Without a budget the mixture is the
    smallest in which every source is used at least once. A source without
    tokens has no share; its documents are kept once.
    """
    totals = stage(rows.groupBy("_source").agg(F.sum("_tokens").alias("_total")))
    whole = totals.select(F.sum("_total")).scalar()
    shares = totals.filter("_total > 0").withColumn("_share", F.col("_total") / whole)
    exponent = bisect_exponent(shares, target_entropy, max_repetition)
    powered = shares.withColumn("_power", F.pow("_share", F.lit(exponent)))
    sums = powered.agg(F.sum("_power").alias("z"), F.max(F.col("_total") / F.col("_power")).alias("once"))
    z = sums.select("z").scalar()
    size = F.lit(float(budget)) if budget is not None else sums.select(F.col("once") * F.col("z")).scalar()
    weighed = powered.withColumn("weight", F.col("_power") / z).withColumn("repetition", F.col("weight") * size / F.col("_total"))
    unweighed = totals.filter("_total = 0").select("*", F.lit(0.0).alias("weight"), F.lit(1.0).alias("repetition"))
    both = weighed.select("_source", "_total", "weight", "repetition").unionByName(unweighed)
    passes = F.floor(F.col("repetition") + 1e-9).cast("bigint")
    rest = F.greatest(F.lit(0), F.floor((F.col("repetition") - passes) * F.col("_total") + 1e-6)).cast("bigint")
    return both.withColumns({"passes": passes, "_rest": rest})


def _cuts(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, cut): the place up to which the partial pass goes, documents of one place together.

    Token totals of blocks tell in which block of a source the budget ends; that
    block alone is cut into smaller ones, and so on, so no source is ever sorted.
    """
    edge = sources.select("_source", "_rest", F.lit(0).cast("bigint").alias("_block"), F.lit(0).cast("bigint").alias("_base"))
    width = 16**PLACE_DIGITS
    rows = rows.select("_source", "_place", "_tokens")
    for _ in range(PLACE_DIGITS // BLOCK_DIGITS):
        inside = rows.join(
            edge.withColumnRenamed("_source", "_s"),
            (F.col("_source") == F.col("_s")) & (F.floor(F.col("_place") / F.lit(width)) == F.col("_block")),
        )
        finer = width // 16**BLOCK_DIGITS
        totals = inside.groupBy("_source", F.floor(F.col("_place") / F.lit(finer)).alias("_block")).agg(
            F.sum("_tokens").alias("_n"), F.first("_rest").alias("_rest"), F.first("_base").alias("_base")
        )
        upto = F.sum("_n").over(Window.partitionBy("_source").orderBy("_block"))
        over = totals.withColumn("_upto", F.col("_base") + upto).filter("_upto > _rest")
        edge = stage(
            over.groupBy("_source").agg(F.min_by(F.struct("_block", "_rest", (F.col("_upto") - F.col("_n")).alias("_base")), "_block").alias("e"))
            .select("_source", "e._rest", "e._block", "e._base")
        )
        width = finer
    # The first place that does not fit any more; the pass ends before it.
    return edge.select("_source", F.col("_block").alias("_cut"))


def with_copies(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repetition: float | None = None,
    budget: float | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 1234,
) -> DataFrame:
    """Add `n_tokens` (words), the source's `weight`, and `copies`: how often the mixture uses the document.

    Columns of those names are replaced. Null sources are one source. Empty texts take no tokens and follow their
    place. Rows that repeat an id share a place and are taken together. The
    partial pass never exceeds its tokens. An empty table stays empty. Only
    (source, place, tokens) move; the plan has one row per source.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    docs = docs.drop("n_tokens", "weight", "copies")
    marked = docs.withColumns({"_source": named, "n_tokens": n_words(text), "_place": place(id_col, seed)})
    narrow = stage(marked.select("_source", "_place", F.col("n_tokens").alias("_tokens")))
    sources = stage(plan(narrow, target_entropy, max_repetition, budget))
    partial = sources.join(_cuts(narrow, sources.filter("_rest > 0")), "_source", "left").select(
        F.col("_source").alias("_s"), "weight", "passes", F.coalesce("_cut", F.lit(0)).alias("_cut")
    )
    out = marked.join(partial, F.col("_source") == F.col("_s"))
    extra = (F.col("_place") < F.col("_cut")).cast("bigint")
    return out.withColumn("copies", F.col("passes") + extra).drop("_source", "_place", "_s", "passes", "_cut")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: each document as often as its copies say, with its own columns only."""
    names = {"id_col": "doc_id", "text": "text", "source": "source"}
    names |= {k: options.pop(k) for k in list(options) if k in names}
    packed = docs.select(F.struct("*").alias("_doc"), *[F.col(name).alias(k) for k, name in names.items()])
    drawn = with_copies(packed, id_col="id_col", **options)
    each = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return drawn.select("_doc", each).select("_doc.*")
