"""Quality rules with thresholds taken from mergeable quantile sketches.

Each language and source has a sketch of every measure: counts of logarithmic
bins, whose relative error is fixed and which merge by adding. A fence around
the middle half of a group's values replaces a fixed cutoff. Groups too small
for a sketch of their own take their language's, then the whole table's.
Everything runs as DataFrame functions; per text, arrays of hashes are worked on
in place, so windows are never rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.session import stage

SPACE = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
#: Words of a repeated window.
WINDOW = 8
#: Smallest value that is not in bin 0, and the ratio of neighbouring bins.
LOWEST, RATIO = 0.001, 1.02
#: Measures with the least half-width of their middle half, so that a constant measure has a fence too.
MEASURES = {"word_length": 0.5, "symbols_per_word": 0.05, "repeated_share": 0.1, "repeated_lines_per_word": 0.02}
#: Only word length also has a lower fence.
TWO_SIDED = ("word_length",)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name a value inside an expression: it is evaluated once, wherever the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: str) -> Column:
    """The words of a whole text; none in a null text."""
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), "")


def _covered(grams: Column) -> Column:
    """Places of a text that lie in a window found twice or more, given the windows' hashes in order."""

    def of_places(p: Column) -> Column:
        reach = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

    def of_sorted(s: Column) -> Column:
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        before = lambda i: F.when(i > 0, F.get(s, i - 1))
        twice = F.filter(s, lambda x, i: same(x, before(i)) | same(x, F.get(s, i + 1)))
        return let(F.sort_array(F.transform(twice, lambda x: x["p"])), of_places)

    pairs = F.transform(grams, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    return let(F.sort_array(pairs), of_sorted)


def repeated_words(listed: Column) -> Column:
    """Words in windows that occur twice or more in the text, the first occurrence included.

    Windows are compared by 64-bit hashes. Texts without a repeat, the most, end
    at a distinct count; the others sort (hash, place) once.
    """

    def of_grams(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_covered(g))

    def of_hashes(h: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(h) - (WINDOW - 1))
        grams = F.transform(at, lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
        return F.when(F.size(h) < 2, F.lit(0)).otherwise(let(grams, of_grams))

    hashes = F.transform(listed, lambda w: F.xxhash64(w))
    return F.when(F.size(listed) < WINDOW + 1, F.lit(0)).otherwise(let(hashes, of_hashes)).cast("bigint")


def repeated_lines(text: str) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(WORD_CHAR))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def counts(text: str = "text") -> dict[str, Column]:
    """The base counts of a whole text; all 0 for a null or empty one."""
    own = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    symbols = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^#*$%&|<>]+", "")).cast("bigint")
    return {"_own": own, "n_symbols": symbols, "n_dup_lines": repeated_lines(text)}


def measures() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "word_length": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "repeated_share": F.col("n_repeat_words") / n,
        "repeated_lines_per_word": F.col("n_dup_lines") / n,
    }


# --- sketches -------------------------------------------------------------


def bin_of(value: Column) -> Column:
    return F.when(value < LOWEST, F.lit(0)).otherwise(F.floor(F.log(value / LOWEST) / F.log(F.lit(RATIO))) + 1).cast("int")


def value_of(b: Column) -> Column:
    """The middle of a bin."""
    return F.when(b == 0, F.lit(0.0)).otherwise(F.lit(LOWEST) * F.pow(F.lit(RATIO), b - 0.5))


def sketch(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by..., measure, bin, n): one sketch per group and measure, combined before the shuffle."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(c).alias("bin")) for m, c in measures().items()]))
    return rows.select(*by, each.alias("e")).groupBy(*by, "e.measure", "e.bin").agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, by: list[str], reach: float) -> DataFrame:
    """(by..., docs, low_*, high_*) from the quartiles of each group's sketches."""
    w = Window.partitionBy(*by, "measure")
    upto = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = sketches.withColumns({"_upto": upto, "_all": F.sum("n").over(w)})
    quartile = lambda q: value_of(F.min(F.when(F.col("_upto") >= q * F.col("_all"), F.col("bin"))))
    per = ranked.groupBy(*by, "measure").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"), F.max("_all").alias("_all"))
    out = []
    for m, least in MEASURES.items():
        is_m = F.col("measure") == m
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * reach
        out.append(F.max(F.when(is_m, F.col("q3") + spread)).alias(f"high_{m}"))
        if m in TWO_SIDED:
            out.append(F.max(F.when(is_m, F.col("q1") - spread)).alias(f"low_{m}"))
    return per.groupBy(*by).agg(F.max("_all").alias("docs"), *out)


def thresholds(rows: DataFrame, reach: float, min_docs: int) -> DataFrame:
    """One row of fences for each (language, source), from the finest sketch with `min_docs` documents."""
    fine = stage(sketch(rows, ["_lang", "_source"]))
    middle = merged(fine, ["_lang"])
    own, lang = fences(fine, ["_lang", "_source"], reach), fences(middle, ["_lang"], reach)
    columns = [c for c in own.columns if c.startswith(("low_", "high_"))]
    whole = fences(merged(middle, []).withColumn("_one", F.lit(1)), ["_one"], reach).first()  # one row of numbers
    lang = lang.select(*[F.col(c).alias(f"l_{c}") for c in lang.columns])
    both = own.join(lang, F.col("_lang") == F.col("l__lang"))
    pick = lambda c: F.when(F.col("docs") >= min_docs, F.col(c)).when(
        F.col("l_docs") >= min_docs, F.col(f"l_{c}")
    ).otherwise(F.lit(whole[c] if whole else None).cast("double"))
    return both.select(F.col("_lang").alias("t_lang"), F.col("_source").alias("t_source"), *[pick(c).alias(c) for c in columns])


def judge(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    reach: float = 3.0, min_docs: int = 50,
) -> DataFrame:
    """Base counts, `base_failed` and `kept` of every row.

    A document of fewer than 20 words, or with over 30 % of its words in repeated
    windows, fails the base; the others form the sketches. One is kept if all its
    measures lie within its group's fences. Null and empty texts fail the base; a
    null language or source is a group like any other; repeated rows each count;
    where no document passes the base there is no fence. Extra columns are not
    read.
    """
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    made = docs.select(F.col(id_col), named(lang).alias("_lang"), named(source).alias("_source"), *[c.alias(n) for n, c in counts(text).items()])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    flat = made.select(id_col, "_lang", "_source", "_own.n_words", "_own.word_chars", "n_symbols", "n_dup_lines", "_own.n_repeat_words")
    rows = stage(flat.withColumn("base_failed", failed))
    fence = thresholds(rows.filter("NOT base_failed"), reach, min_docs)
    joined = rows.join(fence, (F.col("_lang") == F.col("t_lang")) & (F.col("_source") == F.col("t_source")), "left")
    inside = F.lit(True)
    for m, value in measures().items():
        inside = inside & F.coalesce(value <= F.col(f"high_{m}"), F.lit(True))
        if m in TWO_SIDED:
            inside = inside & F.coalesce(value >= F.col(f"low_{m}"), F.lit(True))
    return joined.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"),
    )
