"""URL filter: host and path rules first, then gradient-boosted trees on lexical features."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ("length", "depth", "digit_ratio", "entropy", "params", "host_length", "host_labels", "hyphens", "suffix_rate", "domain_rate")


def _after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty without one and for a null url."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Up to the first `/`, `?` or `#`, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to the first `?` or `#`."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct (rule, verdict), or null.

    Rules are (verdict, "host/path"), a list that is part of the query. A map from
    rule host to its rules is looked up for each suffix of the host, so a page
    meets the rules of its own hosts only, and no row moves.
    """
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    by_host: dict[str, list] = {}
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        one = F.struct(F.lit(slash + rest).alias("path"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        by_host.setdefault(name.lower(), []).append(one)
    table = F.create_map(*[x for h, listed in by_host.items() for x in (F.lit(h), F.array(*listed))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))
    known = F.filter(suffixes, lambda s: s.isin(list(by_host)))
    found = F.filter(F.flatten(F.transform(known, lambda s: table[s])), lambda r: path.startswith(r["path"]))
    ranked = F.transform(
        found, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))
    )
    best = F.array_max(ranked)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _entropy(text: Column) -> Column:
    """Bits per character of the characters' shares."""
    n = F.length(text)
    seen = F.transform(F.array_distinct(F.split(text, "")), lambda c: n - F.length(F.replace(text, c, F.lit(""))))
    parts = F.transform(F.filter(seen, lambda k: k > 0), lambda k: k * F.log2(k))
    return F.when(n > 0, F.log2(n) - F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / n).otherwise(F.lit(0.0))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the characters of a url; all 0 for a null or empty one."""
    u = F.coalesce(url, F.lit(""))
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return {
        "length": F.length(u).cast("double"),
        "depth": count(path, "/[^/]"),
        "digit_ratio": count(u, "[0-9]") / F.greatest(F.length(u), F.lit(1)),
        "entropy": _entropy(u),
        "params": F.when(query == "", F.lit(0.0)).otherwise(count(query, "&") + 1),
        "host_length": F.length(host).cast("double"),
        "host_labels": F.when(host == "", F.lit(0.0)).otherwise(count(host, r"\.") + 1),
        "hyphens": count(host, "-"),
        "suffix": F.substring_index(host, ".", -1),
        "domain": F.substring_index(host, ".", -2),
    }


def _rates(train: DataFrame, key: str, prior: float, weight: float) -> DataFrame:
    """Smoothed share of bad urls for each host suffix."""
    sums = train.groupBy(key).agg(F.sum("_bad").alias("_b"), F.count("*").alias("_n"))
    return sums.select(F.col(key).alias(f"_{key}"), ((F.col("_b") + prior * weight) / (F.col("_n") + weight)).alias(f"{key}_rate"))


def _with_rates(rows: DataFrame, rates: dict[str, DataFrame], prior: float) -> DataFrame:
    for key, table in rates.items():
        rows = rows.join(table, F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}").fillna({f"{key}_rate": prior})
    return rows


def _with_own_rates(train: DataFrame, prior: float, weight: float) -> DataFrame:
    """Training rows with the rates of the other folds' rows, so that no row sees its own label."""
    for key in ("suffix", "domain"):
        fold, whole = Window.partitionBy(key, "_fold"), Window.partitionBy(key)
        bad = F.sum("_bad").over(whole) - F.sum("_bad").over(fold)
        n = F.count("*").over(whole) - F.count("*").over(fold)
        train = train.withColumn(f"{key}_rate", (bad + prior * weight) / (n + weight))
    return train


def threshold_of(held: list[tuple[float, float]], odds: float) -> float:
    """The lowest margin above which a bad held-out url is `odds` times as likely as a good one; infinity if there is none.

    `held` lists (margin, bad). Shares are taken in each class, so the labels'
    balance does not matter, and one good url more than was seen is counted, so a
    few rows prove nothing. Rows of one margin go together.
    """
    n_bad = sum(y for _, y in held)
    n_good = len(held) - n_bad
    best, bad, good = math.inf, 0.0, 0.0
    ordered = sorted(held, reverse=True)
    for i, (margin, own) in enumerate(ordered):
        bad, good = bad + own, good + 1 - own
        last = i + 1 == len(ordered) or ordered[i + 1][0] < margin
        if last and n_bad and bad / n_bad >= odds * (good + 1) / (n_good + 1):
            below = ordered[i + 1][0] if i + 1 < len(ordered) else margin - 1
            best = (margin + below) / 2
    return best


def _margin(trees, names: Sequence[str]) -> Column:
    """The sum of the fitted trees as one expression over the columns of the features: the higher, the more likely bad."""

    def of_node(node) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(node.prediction())
        split = node.split()
        left = F.col(names[split.featureIndex()]) <= F.lit(split.threshold())
        return F.when(left, of_node(node.leftChild())).otherwise(of_node(node.rightChild()))

    parts = [of_node(t._call_java("rootNode")) * F.lit(float(w)) for t, w in zip(trees.trees, trees.treeWeights)]
    return sum(parts[1:], parts[0])


#: Folds of the labelled urls; the first one is held out to set the threshold.
FOLDS = 5


@dataclass
class Judge:
    """Fitted trees as a column, the rates they read, and what was measured on held-out urls."""

    margin: Column
    rates: dict[str, DataFrame]
    prior: float
    threshold: float
    held_bad: int
    held_good: int
    caught: int
    mistaken: int


def fit(labelled: DataFrame, max_rows: int = 10_000, rounds: int = 10, depth: int = 3, smoothing: float = 20.0,
        odds: float = 9.0) -> Judge | str:
    """Fit trees on labelled urls, or give the verdict where there is one class only (`allow` without labels).

    At most `max_rows` rows, those with the lowest hash of their url, are used;
    one in `FOLDS` is held out. Classes weigh the same. The threshold is set on
    the held-out urls (`threshold_of`); where the labels hold no lexical signal
    it is infinite and nothing is blocked. Rows with a null url or label are left
    out; repeated rows count each.
    """
    u = F.col("_url")
    known = labelled.select(F.col("url").alias("_url"), F.col("bad").cast("double").alias("_bad")).dropna()
    known = known.orderBy(F.xxhash64("_url"), "_url", "_bad").limit(max_rows)
    known = known.withColumns({"host": host_of(u), "path": path_of(u), "_fold": F.pmod(F.xxhash64("_url", F.lit("fold")), F.lit(FOLDS))})
    rows = stage(known.select("_bad", "_fold", *[c.alias(n) for n, c in lexical(u, F.col("host"), F.col("path")).items()]))
    n, bad = rows.agg(F.count("*"), F.coalesce(F.sum("_bad"), F.lit(0.0))).first()
    if bad in (0, n):
        return "block" if n and bad else "allow"
    train, held = rows.filter("_fold > 0"), rows.filter("_fold = 0")
    n, bad = train.agg(F.count("*"), F.coalesce(F.sum("_bad"), F.lit(0.0))).first()
    if bad in (0, n):  # too few rows to hold any out
        train, (n, bad) = rows, rows.agg(F.count("*"), F.sum("_bad")).first()
    prior = bad / n
    rates = {key: stage(_rates(train, key, prior, smoothing)) for key in ("suffix", "domain")}
    weight = F.when(F.col("_bad") == 1, n / (2 * bad)).otherwise(n / (2 * (n - bad)))
    pack = VectorAssembler(inputCols=list(LEXICAL), outputCol="_features", handleInvalid="keep")
    ready = pack.transform(_with_own_rates(train, prior, smoothing)).select("_features", "_bad", weight.alias("_weight"))
    trees = GBTClassifier(
        featuresCol="_features", labelCol="_bad", predictionCol="_bad_guess", weightCol="_weight", maxIter=rounds, maxDepth=depth, seed=7,
    ).fit(ready)
    margin = _margin(trees, LEXICAL)
    judged = [(r["m"], r["_bad"]) for r in _with_rates(held, rates, prior).select(margin.alias("m"), "_bad").collect()]
    limit = threshold_of(judged, odds)
    above = [y for m, y in judged if m > limit]
    return Judge(margin, rates, prior, limit, int(sum(y for _, y in judged)), sum(y == 0 for _, y in judged), int(sum(above)), above.count(0.0))


def judge(
    pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url: str = "url", **options
) -> DataFrame:
    """(id, host, path, rule, verdict) of every page: the longest fitting rule's verdict, else that of the trees.

    `labelled` has `url` and `bad` (0 or 1); `options` go to `fit`. A null url has
    empty host and path and features of 0. Repeated pages each keep their row.
    Extra columns are not read.
    """
    u = F.col("_url")
    parts = pages.select(F.col(id_col), F.col(url).alias("_url"))
    parts = parts.withColumns({"host": host_of(u), "path": path_of(u)})
    ruled = parts.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    kept = [F.col(id_col), "host", "path", F.col("_rule.rule").alias("rule")]
    fitted = fit(labelled, **options)
    if isinstance(fitted, str):
        return ruled.select(*kept, F.coalesce(F.col("_rule.verdict"), F.lit(fitted)).alias("verdict"))
    ready = ruled.withColumns(lexical(u, F.col("host"), F.col("path")))
    judged = _with_rates(ready, fitted.rates, fitted.prior)
    own = F.when(fitted.margin > fitted.threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(*kept, F.coalesce(F.col("_rule.verdict"), own).alias("verdict"))


def numbered_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of the pages whose address ends in the number of a labelled document: bad means low quality.

    A page without such a number, or whose document has no label, gives no row; a
    null quality gives a null `bad`. Repeated pages and labels give a row for
    each match.
    """
    number = F.regexp_extract(F.coalesce("url", F.lit("")), r"/([0-9]{1,18})(?:[^0-9/].*)?/?$", 1)
    numbered = pages.select("url", F.when(number != "", number.cast("bigint")).alias("_n"))
    return numbered.join(labels.select(F.col("doc_id").alias("_n"), F.col("quality").alias("_q")), "_n").select(
        "url", (F.col("_q") == 0).cast("int").alias("bad")
    )
