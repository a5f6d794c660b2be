"""Queries of the exploration tables."""

from pyspark.sql import functions as F

from convlens.catalog.base import PROMPTS, SCORED, SQL_WORD, query, r6
from convlens.functions import columns as B
from convlens.functions import text as TX
from convlens.operators import joins, metrics, profile, quality, ranking

LANGS = ["de", "en", "es", "fr"]


@query("value_counts_share", """
WITH v AS (SELECT 'lang' AS "column", lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents),
n AS (SELECT "column", value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", value, n, round(n / sum(n) OVER (PARTITION BY "column"), 6) AS share,
       count(*) OVER (PARTITION BY "column") AS n_categories FROM n""")
def value_counts_share(t):
    survey = profile.category_survey(t("documents"), ["lang", "source"])
    sizes = profile.category_sizes(survey)
    return survey.join(sizes, "column").select(
        "column", "value", "n", r6(F.col("n") / F.col("n_rows")).alias("share"), "n_categories"
    )


@query("value_counts_nulls", """
WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events)
SELECT coalesce(kind, '<NA>') AS kind, count(*) AS n, round(count(*) / (SELECT count(*) FROM e), 6) AS share FROM e GROUP BY 1""")
def value_counts_nulls(t):
    kinds = t("events").select(F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))
    counts = profile.value_counts(kinds, "kind", dropna=False)
    return counts.select(B.or_missing(F.col("kind")).alias("kind"), "n", r6("share").alias("share"))


@query("crosstab_counts", """
SELECT source, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en,
       count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr
FROM documents GROUP BY source""")
def crosstab_counts(t):
    return profile.crosstab(t("documents"), "source", "lang", LANGS)


@query("crosstab_pct_topk", f"""
WITH {PROMPTS}, top AS (
  SELECT source, row_number() OVER (ORDER BY n DESC, source) AS "rank"
  FROM (SELECT source, count(*) AS n FROM prompts GROUP BY source) ORDER BY n DESC, source LIMIT 15)
SELECT "rank", source, round(100.0 * count(*) FILTER (toxic = 0) / count(*), 6) AS unharmful,
       round(100.0 * count(*) FILTER (toxic = 1) / count(*), 6) AS harmful
FROM prompts JOIN top USING (source) GROUP BY "rank", source""")
def crosstab_pct_topk(t):
    rows = t.prompts().select("source", F.when(F.col("toxic") == 1, "harmful").otherwise("unharmful").alias("label"))
    top = profile.top_values(rows, "source", 15).select("source", F.col("rank").cast("bigint").alias("rank"))
    kept = rows.join(top.select("source"), "source", "left_semi")
    table = profile.crosstab(kept, "source", "label", ["unharmful", "harmful"], percent=True)
    return table.join(top, "source").orderBy("rank").select(
        "rank", "source", r6("unharmful").alias("unharmful"), r6("harmful").alias("harmful")
    )


DESCRIBED = """count({x}) AS "count", round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, min({x}) AS "min", """


def sql_quantiles(x: str, probs) -> str:
    return ", ".join(f"round(quantile_cont({x}, {p}), 6) AS p{round(p * 100)}" for p in probs)


WIDE = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def rounded(d, by, probs):
    return d.select(*by, "count", r6("mean").alias("mean"), r6("std").alias("std"), "min",
                    *[r6(f"p{round(p * 100)}").alias(f"p{round(p * 100)}") for p in probs], "max")


@query("describe_by_group", f"""
SELECT lang, {DESCRIBED.format(x='n')} {sql_quantiles('n', WIDE)}, max(n) AS "max"
FROM (SELECT lang, len(regexp_extract_all(text, '{SQL_WORD}')) AS n FROM documents) GROUP BY lang""")
def describe_by_group(t):
    rows = t.texts("documents").select("lang", TX.word_count(F.col("text")).alias("n"))
    return rounded(profile.describe(rows, "n", ["lang"], WIDE), ["lang"], WIDE)


@query("describe_values", f"""
SELECT l_returnflag, {DESCRIBED.format(x='l_extendedprice')} {sql_quantiles('l_extendedprice', WIDE)},
       max(l_extendedprice) AS "max" FROM lineitem GROUP BY l_returnflag""")
def describe_values(t):
    rows = t("lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(profile.describe_values(rows, "l_extendedprice", ["l_returnflag"], WIDE), ["l_returnflag"], WIDE)


@query("describe_side_by_side", f"""
WITH v AS (SELECT 'n_words' AS series, CAST(len(regexp_extract_all(text, '{SQL_WORD}')) AS DOUBLE) AS value FROM documents
           UNION ALL SELECT 'n_chars', CAST(length(text) AS DOUBLE) FROM documents)
SELECT series, {DESCRIBED.format(x='value')} {sql_quantiles('value', (0.25, 0.5, 0.75))}, max(value) AS "max" FROM v GROUP BY series""")
def describe_side_by_side(t):
    rows = t.texts("documents").select(TX.word_count(F.col("text")).alias("n_words"), TX.char_count(F.col("text")).alias("n_chars"))
    return rounded(profile.describe_many(rows, ["n_words", "n_chars"]), ["series"], (0.25, 0.5, 0.75))


@query("column_audit", """
WITH d AS (SELECT *, nullif(source, 'src0') AS maybe FROM documents)
SELECT 'doc_id' AS "column", 'bigint' AS dtype, count(*) FILTER (doc_id IS NULL) AS n_null, 0.0 AS pct_null, count(DISTINCT doc_id) AS n_unique FROM d
UNION ALL SELECT 'text', 'string', count(*) FILTER (text IS NULL), round(100.0 * count(*) FILTER (text IS NULL) / count(*), 6), count(DISTINCT text) FROM d
UNION ALL SELECT 'lang', 'string', count(*) FILTER (lang IS NULL), round(100.0 * count(*) FILTER (lang IS NULL) / count(*), 6), count(DISTINCT lang) FROM d
UNION ALL SELECT 'source', 'string', count(*) FILTER (source IS NULL), round(100.0 * count(*) FILTER (source IS NULL) / count(*), 6), count(DISTINCT source) FROM d
UNION ALL SELECT 'n_chars', 'bigint', count(*) FILTER (n_chars IS NULL), round(100.0 * count(*) FILTER (n_chars IS NULL) / count(*), 6), count(DISTINCT n_chars) FROM d
UNION ALL SELECT 'maybe', 'string', count(*) FILTER (maybe IS NULL), round(100.0 * count(*) FILTER (maybe IS NULL) / count(*), 6), count(DISTINCT maybe) FROM d""")
def column_audit(t):
    rows = t("documents").withColumn("maybe", F.nullif(F.col("source"), F.lit("src0")))
    return profile.column_audit(rows).withColumn("pct_null", r6("pct_null"))


@query("group_rates", f"""
WITH {SCORED}
SELECT CASE WHEN adversarial THEN 'adversarial' ELSE 'normal' END AS "group",
       CASE WHEN harm = 1 THEN 'recall' ELSE 'specificity' END AS metric,
       count(*) AS n, round(avg(CAST(pred = harm AS INTEGER)), 6) AS accuracy
FROM scored GROUP BY adversarial, harm""")
def group_rates(t):
    rows = t.scored().withColumn("correct", B.correct(F.col("pred"), F.col("harm")))
    table = metrics.group_accuracy(rows, ["adversarial", "harm"])
    return table.select(
        B.group_name(F.col("adversarial")).alias("group"), B.metric_name(F.col("harm")).alias("metric"),
        "n", r6("accuracy").alias("accuracy"),
    )


@query("group_multi_aggregates", f"""
WITH {SCORED}
SELECT source, count(*) AS n, round(avg(harm), 6) AS harm_rate, round(avg(CAST(pred = harm AS INTEGER)), 6) AS score,
       CASE WHEN avg(harm) > 0.5 THEN 'recall' ELSE 'specificity' END AS metric,
       count(*) FILTER (harm = 1 AND pred = 0) AS missed, count(DISTINCT lang) AS n_langs
FROM scored GROUP BY source""")
def group_multi_aggregates(t):
    return t.scored().groupBy("source").agg(
        F.count("*").alias("n"), r6(F.avg("harm")).alias("harm_rate"),
        r6(F.avg((F.col("pred") == F.col("harm")).cast("int"))).alias("score"),
        F.when(F.avg("harm") > 0.5, "recall").otherwise("specificity").alias("metric"),
        F.count_if((F.col("harm") == 1) & (F.col("pred") == 0)).alias("missed"),
        F.count_distinct("lang").alias("n_langs"),
    )


@query("p99_trim", f"""
WITH w AS (SELECT doc_id, len(regexp_extract_all(text, '{SQL_WORD}')) AS n FROM documents),
q AS (SELECT quantile_cont(n, 0.99) AS q FROM w)
SELECT round(any_value(q), 6) AS upper, count(*) FILTER (n <= q) AS kept, count(*) FILTER (n > q) AS excluded,
       round(avg(CAST(n <= 500 AS INTEGER)), 6) AS share_to_500, round(median(n), 6) AS median
FROM w, q""")
def p99_trim(t):
    rows = t.texts("documents").select("doc_id", TX.word_count(F.col("text")).alias("n"))
    kept = profile.below_quantile(rows, "n").agg(F.count("*")).scalar()
    return rows.agg(
        r6(F.percentile("n", F.lit(0.99))).alias("upper"), F.count("*").alias("_all"),
        r6(F.avg((F.col("n") <= 500).cast("int"))).alias("share_to_500"), r6(F.median("n")).alias("median"),
    ).select("upper", kept.alias("kept"), (F.col("_all") - kept).alias("excluded"), "share_to_500", "median")


@query("p99_trim_values", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.99) AS q FROM orders)
SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 6) AS top
FROM orders, q WHERE o_totalprice < q GROUP BY o_orderpriority""")
def p99_trim_values(t):
    rows = t("orders").select("o_orderpriority", "o_totalprice")
    kept = profile.below_quantile(rows, "o_totalprice", strict=True, domain="values")
    return kept.groupBy("o_orderpriority").agg(F.count("*").alias("n"), r6(F.max("o_totalprice")).alias("top"))


@query("histogram_density", """
WITH h AS (SELECT l_returnflag, CASE WHEN l_quantity = 50 THEN 9 ELSE CAST(floor(l_quantity / 5) AS INTEGER) END AS bucket
           FROM lineitem WHERE l_quantity BETWEEN 0 AND 50),
n AS (SELECT l_returnflag, bucket, count(*) AS n FROM h GROUP BY ALL)
SELECT l_returnflag, bucket, n, round(n / (sum(n) OVER (PARTITION BY l_returnflag) * 5.0), 6) AS density FROM n""")
def histogram_density(t):
    h = profile.histogram(t("lineitem"), "l_quantity", 0.0, 5.0, 10, ["l_returnflag"])
    return h.withColumn("density", r6("density"))


BINNED = """
ends AS (SELECT CAST(min(n_chars) AS DOUBLE) AS lo, CAST(max(n_chars) AS DOUBLE) AS hi FROM prompts WHERE toxic = 1),
bins AS (
  SELECT CAST(i AS INTEGER) AS bin,
         CASE WHEN i = 1 THEN lo - 0.001 ELSE lo + CAST(i - 1 AS DOUBLE) * ((hi - lo) / 20) END AS l,
         CASE WHEN i = 20 THEN hi ELSE lo + CAST(i AS DOUBLE) * ((hi - lo) / 20) END AS r
  FROM range(1, 21) AS s(i), ends)"""


@query("bin_sufficiency", f"""
WITH {PROMPTS}, {BINNED}
SELECT bin, count(*) FILTER (toxic = 1) AS needed, count(*) FILTER (toxic = 0) AS available,
       count(*) FILTER (toxic = 0) >= count(*) FILTER (toxic = 1) AS sufficient,
       greatest(count(*) FILTER (toxic = 1) - count(*) FILTER (toxic = 0), 0) AS shortfall
FROM bins LEFT JOIN prompts ON n_chars > l AND n_chars <= r GROUP BY bin""")
def bin_sufficiency(t):
    rows = t.prompts().select("n_chars", "toxic")
    harmful, benign = rows.filter("toxic = 1"), rows.filter("toxic = 0")
    limits = profile.edges(harmful, "n_chars")
    return profile.bin_sufficiency(
        profile.bin_counts(harmful, "n_chars", limits), profile.bin_counts(benign, "n_chars", limits)
    )


@query("boxplot_stats", f"""
WITH {PROMPTS}, w AS (SELECT quality, toxic, len(regexp_extract_all(text, '{SQL_WORD}')) AS n FROM prompts),
q AS (SELECT quality, toxic, count(*) AS c, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS med, quantile_cont(n, 0.75) AS q3 FROM w GROUP BY ALL)
SELECT quality, toxic, any_value(c) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
       min(n) FILTER (n BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_lo,
       max(n) FILTER (n BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_hi,
       count(*) FILTER (n NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM w JOIN q USING (quality, toxic) GROUP BY quality, toxic""")
def boxplot_stats(t):
    rows = t.prompt_texts().select("quality", "toxic", TX.word_count(F.col("text")).alias("n"))
    return profile.boxplot(rows.withColumnRenamed("n", "words"), "words", ["quality", "toxic"]).select(
        "quality", "toxic", "n", r6("q1").alias("q1"), r6("median").alias("median"), r6("q3").alias("q3"),
        "whisker_lo", "whisker_hi", "n_outliers",
    )


@query("distribution_difference", """
WITH a AS (SELECT o_orderpriority AS v, count(*) AS n_a FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
b AS (SELECT o_orderpriority AS v, count(*) AS n_b FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT v AS o_orderpriority, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b FROM a FULL JOIN b USING (v)
WHERE coalesce(n_a, 0) <> coalesce(n_b, 0)""")
def distribution_difference(t):
    orders = t("orders").select("o_orderpriority", "o_orderstatus")
    return quality.same_distribution(
        orders.filter("o_orderstatus = 'O'"), orders.filter("o_orderstatus = 'F'"), "o_orderpriority"
    )


@query("union_tagged", f"""
WITH {PROMPTS}, u AS (
  SELECT 'train' AS split, doc_id, toxic AS harm, lang FROM prompts WHERE quality = 1
  UNION ALL SELECT 'test', doc_id, toxic, lang FROM prompts WHERE quality = 0)
SELECT split, count(*) AS n, round(avg(harm), 6) AS harm_rate, count(DISTINCT lang) AS n_langs FROM u GROUP BY split""")
def union_tagged(t):
    rows = t.prompts().select("doc_id", "quality", F.col("toxic").alias("harm"), "lang")
    both = joins.union_tagged({"train": rows.filter("quality = 1"), "test": rows.filter("quality = 0")}, "split")
    return both.groupBy("split").agg(
        F.count("*").alias("n"), r6(F.avg("harm")).alias("harm_rate"), F.count_distinct("lang").alias("n_langs")
    )


@query("join_one_to_one", f"""
WITH {PROMPTS}
SELECT doc_id, lang, toxic AS harm FROM prompts""")
def join_one_to_one(t):
    features = t("documents").select("doc_id", "text", "lang")
    labels = t("labels").select("doc_id", F.col("toxic").alias("harm"))
    joined = joins.one_to_one(features, labels, "doc_id")
    quality.require(joined, quality.text_rules("text", "harm"))
    return joined.select("doc_id", "lang", "harm")


@query("left_join_metadata", """
SELECT o_orderkey, c_mktsegment, n_name, c_custkey IS NULL OR n_name IS NULL AS missing
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def left_join_metadata(t):
    orders = t("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    with_customer = joins.attach(orders, t("customer"), "c_custkey", ["c_mktsegment", "c_nationkey"], complete=False)
    nation = t("nation").withColumnRenamed("n_nationkey", "c_nationkey")
    full = joins.attach(with_customer, nation, "c_nationkey", ["n_name"], complete=False)
    return full.select("o_orderkey", "c_mktsegment", "n_name", F.col("n_name").isNull().alias("missing"))


@query("label_prompt_or_response", f"""
WITH {PROMPTS}, l AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'harmful' WHEN n_chars > 3000 THEN NULL ELSE 'unharmful' END AS p,
         CASE WHEN n_chars < 400 THEN NULL WHEN quality = 0 THEN 'harmful' ELSE 'unharmful' END AS r,
         CAST(least(n_chars, 5000) / 5000.0 >= 0.5 AS INTEGER) AS pred FROM prompts),
h AS (SELECT *, CAST(p IS NOT NULL AND p = 'harmful' OR r IS NOT NULL AND r = 'harmful' AS INTEGER) AS harm FROM l)
SELECT doc_id, CAST(p IS NOT NULL AND p = 'harmful' AS INTEGER) AS prompt_harm, harm, pred, pred = harm AS correct,
       CASE WHEN harm = 0 AND pred = 1 THEN 'false_positive' WHEN harm = 1 AND pred = 0 THEN 'false_negative' ELSE 'correct' END AS error_type
FROM h""")
def label_prompt_or_response(t):
    n = F.col("n_chars")
    rows = t.prompts().select(
        "doc_id", F.when(F.col("toxic") == 1, "harmful").when(n > 3000, None).otherwise("unharmful").alias("p"),
        F.when(n < 400, None).when(F.col("quality") == 0, "harmful").otherwise("unharmful").alias("r"),
        (F.least(n, F.lit(5000)) / 5000.0).alias("prob"),
    )
    rows = rows.withColumn("harm", B.harm_of(F.col("p"), F.col("r"))).withColumn("pred", B.predicted(F.col("prob")))
    return rows.select(
        "doc_id", B.equals(F.col("p"), "harmful").alias("prompt_harm"), "harm", "pred",
        B.correct(F.col("pred"), F.col("harm")).alias("correct"),
        B.error_type(F.col("harm"), F.col("pred")).alias("error_type"),
    )


@query("bool_normalise", """
WITH e AS (SELECT event_id, value, json_extract_string(props, '$.k') AS k, event_type FROM events),
m AS (SELECT *, CASE event_type WHEN 'click' THEN ' TRUE ' WHEN 'view' THEN '1' WHEN 'error' THEN NULL ELSE 'no' END AS raw FROM e)
SELECT event_id, coalesce(lower(trim(raw)) IN ('true', '1'), false) AS flag, coalesce(raw, '<NA>') AS shown,
       round(least(greatest(value, 1.0), 20.0), 6) AS clipped, CAST(k AS INTEGER) AS k FROM m""")
def bool_normalise(t):
    kind = F.col("event_type")
    raw = F.when(kind == "click", " TRUE ").when(kind == "view", "1").when(kind == "error", None).otherwise("no")
    rows = t("events").withColumn("raw", raw)
    return rows.select(
        "event_id", B.as_boolean(F.col("raw")).alias("flag"), B.or_missing(F.col("raw")).alias("shown"),
        r6(B.clip(F.col("value"), 1.0, 20.0)).alias("clipped"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
