"""Queries of metrics over the scored prompts."""

import json
import math

from pyspark.sql import functions as F

from convlens.catalog.base import SCORED, query, r6
from convlens.functions import columns as B
from convlens.operators import bootstrap, metrics, models

RATIO = "CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


def ratio(a: str, b: str) -> str:
    return RATIO.format(a=a, b=b)


def outcomes(by: str = "", source: str = "scored") -> str:
    lead = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""o AS (SELECT {lead}count(*) FILTER (harm = 0 AND pred = 0) AS tn, count(*) FILTER (harm = 0 AND pred = 1) AS fp,
  count(*) FILTER (harm = 1 AND pred = 0) AS fn, count(*) FILTER (harm = 1 AND pred = 1) AS tp FROM {source}{tail})"""


def steps(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""c AS (SELECT {lead}score, sum(harm) AS pos, sum(1 - harm) AS neg FROM scored GROUP BY {lead}score),
steps AS (SELECT *, CAST(sum(pos) OVER ({part} ORDER BY score DESC) AS DOUBLE) AS tp, CAST(sum(neg) OVER ({part} ORDER BY score DESC) AS DOUBLE) AS fp,
          CAST(sum(pos) OVER ({part}) AS DOUBLE) AS np, CAST(sum(neg) OVER ({part}) AS DOUBLE) AS nn FROM c)"""


@query("confusion_matrix", f"""
WITH {SCORED}, g AS (SELECT l.range AS label, p.range AS pred FROM range(2) l, range(2) p)
SELECT CAST(g.label AS INTEGER) AS label, CAST(g.pred AS INTEGER) AS pred, count(s.doc_id) AS n
FROM g LEFT JOIN scored s ON s.harm = g.label AND s.pred = g.pred GROUP BY g.label, g.pred""")
def confusion_matrix(t):
    return metrics.confusion_matrix(t.scored(), "harm", "pred")


def sql_report(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    p0, r0, f0 = ratio("tn", "tn + fn"), ratio("tn", "tn + fp"), ratio("2 * tn", "2 * tn + fn + fp")
    p1, r1, f1 = ratio("tp", "tp + fp"), ratio("tp", "tp + fn"), ratio("2 * tp", "2 * tp + fp + fn")
    n, s0, s1 = "(tn + fp + fn + tp)", "(tn + fp)", "(tp + fn)"

    def row(name, values, support):
        p, r, f = (f"round({v}, 6)" for v in values)
        return f"SELECT {lead}'{name}' AS class, {p} AS precision, {r} AS recall, {f} AS f1, {support} AS support FROM o"

    acc = ratio("tp + tn", n)
    macro = [f"({a} + {b}) / 2" for a, b in ((p0, p1), (r0, r1), (f0, f1))]
    weighted = [f"({a} * {s0} + {b} * {s1}) / {n}" for a, b in ((p0, p1), (r0, r1), (f0, f1))]
    return " UNION ALL ".join(
        [row("unharmful", (p0, r0, f0), s0), row("harmful", (p1, r1, f1), s1), row("accuracy", (acc,) * 3, n),
         row("macro avg", macro, n), row("weighted avg", weighted, n)]
    )


def rounded_report(report, *by):
    return report.select(*by, "class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("classification_report", f"WITH {SCORED}, {outcomes()} {sql_report()}")
def classification_report(t):
    return rounded_report(metrics.classification_report(t.scored(), "harm", "pred"))


@query("subgroup_report", f"WITH {SCORED}, {outcomes('adversarial')} {sql_report('adversarial')}")
def subgroup_report(t):
    return rounded_report(metrics.classification_report(t.scored(), "harm", "pred", ["adversarial"]), "adversarial")


@query("binary_metrics", f"""
WITH {SCORED}, {outcomes()}
SELECT tn + fp + fn + tp AS n, round({ratio('tp + tn', '(tn + fp + fn + tp)')}, 6) AS accuracy, round({ratio('tp', 'tp + fp')}, 6) AS precision,
       round({ratio('tp', 'tp + fn')}, 6) AS recall, round({ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS f1,
       round(({ratio('2 * tp', '2 * tp + fp + fn')} + {ratio('2 * tn', '2 * tn + fp + fn')}) / 2, 6) AS f1_macro FROM o""")
def binary_metrics(t):
    m = metrics.binary_metrics(t.scored(), "harm", "pred")
    return m.select("n", *[r6(c).alias(c) for c in m.columns if c != "n"])


@query("roc_curve", f"""
WITH {SCORED}, {steps('adversarial')}
SELECT adversarial, score AS threshold, round({ratio('fp', 'nn')}, 6) AS fpr, round({ratio('tp', 'np')}, 6) AS tpr FROM steps
UNION ALL SELECT DISTINCT adversarial, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM scored""")
def roc_curve(t):
    points = metrics.roc_curve(t.scored(), "harm", "score", ["adversarial"])
    return points.select("adversarial", "threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("pr_curve", f"""
WITH {SCORED}, {steps()}
SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round({ratio('tp', 'np')}, 6) AS recall FROM steps
UNION ALL SELECT NULL, 1.0, 0.0""")
def pr_curve(t):
    points = metrics.pr_curve(t.scored(), "harm", "score")
    return points.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


# Pair counting gives the area under the ROC curve without any curve.
AUC = """(SELECT CAST(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS DOUBLE) / count(*)
  FROM scored a, scored b WHERE a.harm = 1 AND b.harm = 0)"""


@query("roc_auc", f"WITH {SCORED} SELECT round({AUC}, 6) AS roc_auc")
def roc_auc(t):
    return metrics.curve_areas(t.scored(), "harm", "score").select(r6("roc_auc").alias("roc_auc"))


@query("average_precision", f"""
WITH {SCORED}, {steps()},
l AS (SELECT *, tp / (tp + fp) AS p, tp / np AS r, coalesce(lag(tp / (tp + fp)) OVER (ORDER BY score DESC), 1.0) AS p0,
             coalesce(lag(tp / np) OVER (ORDER BY score DESC), 0.0) AS r0 FROM steps)
SELECT round(sum((r - r0) * p), 6) AS average_precision, round(sum((r - r0) * (p + p0) / 2), 6) AS pr_auc FROM l""")
def average_precision(t):
    areas = metrics.curve_areas(t.scored(), "harm", "score")
    return areas.select(r6("average_precision").alias("average_precision"), r6("pr_auc").alias("pr_auc"))


@query("recall_at_precision", f"""
WITH {SCORED}, {steps()}
SELECT round(coalesce(max(tp / np) FILTER (tp / (tp + fp) >= 0.15), 0.0), 6) AS at_15,
       round(coalesce(max(tp / np) FILTER (tp / (tp + fp) >= 0.95), 0.0), 6) AS at_95 FROM steps""")
def recall_at_precision(t):
    low = metrics.curve_areas(t.scored(), "harm", "score", target_precision=0.15).select("recall_at_precision").scalar()
    high = metrics.curve_areas(t.scored(), "harm", "score")
    return high.select(r6(low).alias("at_15"), r6("recall_at_precision").alias("at_95"))


@query("subgroup_metrics", f"""
WITH {SCORED}, {outcomes('source')},
a AS (SELECT source, CAST(sum(CASE WHEN x.score > y.score THEN 1.0 WHEN x.score = y.score THEN 0.5 ELSE 0.0 END) AS DOUBLE) / count(*) AS auc
      FROM (SELECT * FROM scored WHERE harm = 1) x JOIN (SELECT * FROM scored WHERE harm = 0) y USING (source) GROUP BY source)
SELECT o.source AS source, tn + fp + fn + tp AS n, round({ratio('tp + tn', '(tn + fp + fn + tp)')}, 6) AS accuracy, round({ratio('tp', 'tp + fp')}, 6) AS precision,
       round({ratio('tp', 'tp + fn')}, 6) AS recall, round({ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS f1,
       round(({ratio('2 * tp', '2 * tp + fp + fn')} + {ratio('2 * tn', '2 * tn + fp + fn')}) / 2, 6) AS f1_macro,
       round(auc, 6) AS roc_auc FROM o LEFT JOIN a ON o.source = a.source""")
def subgroup_metrics(t):
    m = metrics.subgroup_metrics(t.scored(), "harm", "pred", "score", "source")
    return m.select("source", "n", *[r6(c).alias(c) for c in m.columns if c not in ("source", "n")])


@query("miss_rates", f"""
WITH {SCORED}, m AS (SELECT source, count(*) FILTER (pred = 0) AS missed, count(*) AS total FROM scored WHERE harm = 1 GROUP BY source)
SELECT source, missed, total, round(missed / total, 6) AS miss_rate, source || '  (' || missed || '/' || total || ')' AS label FROM m""")
def miss_rates(t):
    m = metrics.miss_rates(t.scored(), "harm", "pred", "source").orderBy("miss_rate")
    return m.select("source", "missed", "total", r6("miss_rate").alias("miss_rate"),
                    B.counted_label(F.col("source"), F.col("missed"), F.col("total")).alias("label"))


@query("calibration", f"""
WITH {SCORED}, e AS (SELECT *, len(list_filter([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0], lambda x: score > CAST(x AS DOUBLE))) AS b FROM scored)
SELECT format('{{:.1f}}-{{:.1f}}', (b - 1) / 10, b / 10) AS bucket, count(*) AS n,
       round(avg(CAST(harm = pred AS INTEGER)), 6) AS accuracy, round(avg(harm), 6) AS actual_rate
FROM e WHERE b BETWEEN 1 AND 10 GROUP BY b""")
def calibration(t):
    c = metrics.calibration(t.scored(), "harm", "pred", "score")
    return c.select("bucket", "n", r6("accuracy").alias("accuracy"), r6("actual_rate").alias("actual_rate"))


@query("error_examples", f"""
WITH {SCORED}, r AS (
  SELECT s.doc_id, s.score, s.harm, s.pred, s.source, d.text, s.adversarial,
         CASE WHEN s.harm = 1 THEN 'miss' ELSE 'false alarm' END AS kind,
         row_number() OVER (PARTITION BY s.harm ORDER BY CASE WHEN s.harm = 1 THEN s.score ELSE -s.score END, s.doc_id) AS k
  FROM scored s JOIN documents d USING (doc_id) WHERE s.pred <> s.harm)
SELECT kind, doc_id, '[WRONG]  p(harmful)=' || format('{{:.2f}}', score) || '  true=' || harm || '  ' || source || '  adversarial=' || adversarial AS headline,
       substr(text, 1, 260) AS shown FROM r WHERE k <= 5""")
def error_examples(t):
    wrong = t.scored().filter("pred <> harm")
    misses = wrong.filter("harm = 1").orderBy("score", "doc_id").limit(5).withColumn("kind", F.lit("miss"))
    alarms = wrong.filter("harm = 0").orderBy(F.desc("score"), "doc_id").limit(5).withColumn("kind", F.lit("false alarm"))
    shown = misses.unionByName(alarms).join(t("documents").select("doc_id", "text"), "doc_id")
    headline = F.format_string("[WRONG]  p(harmful)=%.2f  true=%d  %s  adversarial=%s", "score", "harm", "source", F.col("adversarial").cast("string"))
    return shown.select("kind", "doc_id", headline.alias("headline"), B.excerpt(F.col("text"), 260).alias("shown"))


@query("dataset_comparison", f"""
WITH {SCORED}, u AS (SELECT lang AS dataset, * FROM scored), {outcomes('dataset', 'u')}
SELECT dataset, tn + fp + fn + tp AS n, round({ratio('tp + tn', '(tn + fp + fn + tp)')}, 6) AS accuracy, round({ratio('tp', 'tp + fp')}, 6) AS precision,
       round({ratio('tp', 'tp + fn')}, 6) AS recall, round({ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM o""")
def dataset_comparison(t):
    m = metrics.binary_metrics(t.scored().withColumnRenamed("lang", "dataset"), "harm", "pred", ["dataset"])
    return m.select("dataset", "n", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


RUNS = "runs AS (SELECT lang AS arm, CAST(substr(source, 4) AS INTEGER) AS seed, avg(CAST(pred = harm AS INTEGER)) AS metric FROM scored GROUP BY 1, 2)"


def runs(t):
    seed = F.substring("source", 4, 10).cast("int")
    return t.scored().groupBy(F.col("lang").alias("arm"), seed.alias("seed")).agg(
        F.avg((F.col("pred") == F.col("harm")).cast("int")).alias("metric")
    )


@query("seed_comparison", f"""
WITH {SCORED}, {RUNS}, a AS (SELECT median(metric) FILTER (arm = 'en') AS ma, median(metric) FILTER (arm = 'fr') AS mb,
  stddev_pop(metric) FILTER (arm = 'en') AS sa FROM runs)
SELECT round(ma, 6) AS median_a, round(mb, 6) AS median_b, round(sa, 6) AS sigma_a, round(mb - ma, 6) AS delta, mb - ma > sa AS reject FROM a""")
def seed_comparison(t):
    c = metrics.seed_comparison(runs(t), "arm", "metric", "en", "fr")
    return c.select(*[r6(x).alias(x) for x in ("median_a", "median_b", "sigma_a", "delta")], "reject")


@query("best_runs", f"""
WITH {SCORED}, {RUNS}, r AS (SELECT *, row_number() OVER (PARTITION BY arm ORDER BY metric DESC, seed) AS k FROM runs)
SELECT arm, seed, round(metric, 6) AS metric FROM r WHERE k = 1""")
def best_runs(t):
    return metrics.best_runs(runs(t), "arm", "metric", "seed").withColumn("metric", r6("metric"))


def sql_draw(key: str, n: str, replicate: str) -> str:
    """One Poisson draw of a cell: its digest against the distribution of its size."""
    digest = f"md5('0|' || {key} || '|' || {replicate})"
    u, v = (f"((CAST('0x' || substr({digest}, {at}, 12) AS BIGINT) + 0.5) / {float(1 << 48)!r})" for at in (1, 13))
    z = f"(sqrt(-2 * ln({u})) * cos({2 * math.pi!r} * {v}))"
    exact = f"len(list_filter({json.dumps(bootstrap.distributions())}[CAST({n} AS BIGINT)], lambda c: CAST(c AS DOUBLE) <= {u}))"
    wide = f"greatest(0, floor({n} + sqrt({n}) * {z} + ({z} * {z} - 1) / 6 + 0.5))"
    return f"CASE WHEN {n} = 0 THEN 0 WHEN {n} <= {bootstrap.EXACT} THEN {exact} ELSE CAST({wide} AS BIGINT) END"


F1_MACRO = "({} + {}) / 2".format(ratio("2 * tp", "2 * tp + fp + fn"), ratio("2 * tn", "2 * tn + fp + fn"))


@query("bootstrap_ci", f"""
WITH {SCORED}, reps AS (SELECT range AS r FROM range(1000)),
four AS (SELECT harm, pred, count(*) AS n FROM scored GROUP BY harm, pred),
drawn AS (SELECT r, harm, pred, {sql_draw("'cell|' || harm || '|' || pred", "n", "r")} AS w FROM four, reps),
o AS (SELECT r, sum(w) FILTER (harm = 0 AND pred = 0) AS tn, sum(w) FILTER (harm = 0 AND pred = 1) AS fp,
             sum(w) FILTER (harm = 1 AND pred = 0) AS fn, sum(w) FILTER (harm = 1 AND pred = 1) AS tp FROM drawn GROUP BY r),
f AS (SELECT {F1_MACRO} AS f1 FROM (SELECT coalesce(tn, 0) AS tn, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, coalesce(tp, 0) AS tp FROM o)),
cells AS (SELECT score, sum(harm) AS pos, sum(1 - harm) AS neg FROM scored GROUP BY score),
steps AS (SELECT r, score, {sql_draw("printf('%.9f', score) || '|1'", "pos", "r")} AS p, {sql_draw("printf('%.9f', score) || '|0'", "neg", "r")} AS n FROM cells, reps),
runs AS (SELECT *, sum(p) OVER (PARTITION BY r ORDER BY score DESC) AS tp FROM steps),
a AS (SELECT sum(n * (2 * tp - p) / 2) / (sum(p) * sum(n)) AS auc FROM runs GROUP BY r HAVING sum(p) > 0 AND sum(n) > 0)
SELECT 'f1_macro' AS metric, round(quantile_cont(f1, 0.025), 6) AS lo, round(quantile_cont(f1, 0.975), 6) AS hi, count(*) AS replicates FROM f
UNION ALL SELECT 'roc_auc', round(quantile_cont(auc, 0.025), 6), round(quantile_cont(auc, 0.975), 6), count(*) FROM a""")
def bootstrap_ci(t):
    scored = t.scored()
    found = bootstrap.f1_macro_interval(scored, "harm", "pred").unionByName(
        bootstrap.roc_auc_interval(scored, "harm", "score")
    )
    return found.select("metric", r6("lo").alias("lo"), r6("hi").alias("hi"), "replicates")


@query("false_alarm_rates", f"""
WITH {SCORED}, m AS (SELECT source, count(*) FILTER (pred = 1) AS false_alarms, count(*) AS total FROM scored WHERE harm = 0 GROUP BY source)
SELECT source, false_alarms, total, round(false_alarms / total, 6) AS false_alarm_rate FROM m""")
def false_alarm_rates(t):
    m = metrics.false_alarm_rates(t.scored(), "harm", "pred", "source")
    return m.select("source", "false_alarms", "total", r6("false_alarm_rate").alias("false_alarm_rate"))


@query("calibration_by_group", f"""
WITH {SCORED}, e AS (SELECT *, len(list_filter([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0], lambda x: score > CAST(x AS DOUBLE))) AS b FROM scored)
SELECT source, format('{{:.1f}}-{{:.1f}}', (b - 1) / 10, b / 10) AS bucket, count(*) AS n,
       round(avg(CAST(harm = pred AS INTEGER)), 6) AS accuracy, round(avg(harm), 6) AS actual_rate
FROM e WHERE b BETWEEN 1 AND 10 GROUP BY source, b""")
def calibration_by_group(t):
    c = metrics.calibration(t.scored(), "harm", "pred", "score", by=["source"])
    return c.select("source", "bucket", "n", r6("accuracy").alias("accuracy"), r6("actual_rate").alias("actual_rate"))


# Train and validation scores of runs, taken from two languages; one run per source.
@query("ranked_runs", f"""
WITH {SCORED}, r AS (
  SELECT CAST(substr(source, 4) AS INTEGER) AS run, avg(CAST(pred = harm AS INTEGER)) FILTER (lang = 'en') AS train_pr,
         avg(CAST(pred = harm AS INTEGER)) FILTER (lang = 'fr') AS val_pr FROM scored GROUP BY source),
g AS (SELECT *, abs(val_pr - train_pr) AS gap FROM r WHERE val_pr IS NOT NULL AND train_pr IS NOT NULL)
SELECT run, round(train_pr, 6) AS train_pr, round(val_pr, 6) AS val_pr, round(gap, 6) AS gap,
       row_number() OVER (ORDER BY val_pr DESC, run) AS rank_val, row_number() OVER (ORDER BY gap, run) AS rank_gap FROM g""")
def ranked_runs(t):
    right = (F.col("pred") == F.col("harm")).cast("int")
    table = t.scored().groupBy(F.substring("source", 4, 10).cast("int").alias("run")).agg(
        F.avg(F.when(F.col("lang") == "en", right)).alias("train_pr"), F.avg(F.when(F.col("lang") == "fr", right)).alias("val_pr")
    )
    table = table.dropna().withColumn("gap", F.abs(F.col("val_pr") - F.col("train_pr")))
    ranked = models.ranked_runs(table)
    return ranked.select("run", *[r6(c).alias(c) for c in ("train_pr", "val_pr", "gap")],
                         F.col("rank_val").cast("bigint").alias("rank_val"), F.col("rank_gap").cast("bigint").alias("rank_gap"))
