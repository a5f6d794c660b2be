"""Queries of samples, splits and ids."""

from pyspark.sql import functions as F

from convlens.catalog.base import PROMPTS, query, r6
from convlens.catalog.profiles import BINNED
from convlens.operators import quality, sampling


def key(col: str, seed: int = 1234) -> str:
    return f"md5(concat_ws('|', {col}, '{seed}'))"


@query("sample_exact", f"""
SELECT doc_id, lang FROM documents ORDER BY {key('doc_id', 42)}, doc_id LIMIT 100""")
def sample_exact(t):
    return sampling.sample_exact(t("documents").select("doc_id", "lang"), 100, "doc_id", 42)


@query("shuffle_positions", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {key('o_orderkey')}, o_orderkey) AS position FROM orders""")
def shuffle_positions(t):
    return sampling.shuffled(t("orders").select("o_orderkey"), "o_orderkey")


@query("sample_balanced", f"""
WITH {PROMPTS}, r AS (SELECT doc_id, toxic AS harm, row_number() OVER (PARTITION BY toxic ORDER BY {key('doc_id')}, doc_id) AS k FROM prompts)
SELECT doc_id, harm FROM r WHERE k <= CASE WHEN harm = 1 THEN 21 ELSE 20 END""")
def sample_balanced(t):
    rows = t.prompts().select("doc_id", F.col("toxic").alias("harm"))
    return sampling.sample_balanced(rows, 41, "harm", "doc_id", complete=False)


@query("sample_per_group", f"""
SELECT c_custkey, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {key('c_custkey')}, c_custkey) AS k FROM customer) WHERE k <= 100""")
def sample_per_group(t):
    rows = t("customer").select("c_custkey", "c_mktsegment")
    return sampling.sample_per_group(rows, 100, "c_mktsegment", "c_custkey")


MATCHED = f"""
WITH {PROMPTS}, {BINNED},
placed AS (SELECT doc_id, toxic, n_chars, bin FROM prompts JOIN bins ON n_chars > l AND n_chars <= r),
needed AS (SELECT bin, count(*) AS quota FROM placed WHERE toxic = 1 GROUP BY bin),
pool AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY {key('doc_id')}, doc_id) AS k FROM placed WHERE toxic = 0),
matched AS (SELECT doc_id, n_chars, bin FROM pool JOIN needed USING (bin) WHERE k <= quota)"""


@query("sample_length_matched", MATCHED + " SELECT doc_id, n_chars, bin FROM matched")
def sample_length_matched(t):
    rows = t.prompts().select("doc_id", "n_chars", "toxic")
    return sampling.sample_matched(
        rows.filter("toxic = 1"), rows.filter("toxic = 0").drop("toxic"), "n_chars", "doc_id"
    )


@query("matched_sample_check", MATCHED + """
SELECT (SELECT count(*) FROM matched) AS n_matched, (SELECT count(*) FROM prompts WHERE toxic = 1) AS n_target,
       (SELECT round(median(n_chars), 6) FROM matched) AS median_matched,
       (SELECT round(median(n_chars), 6) FROM prompts WHERE toxic = 1) AS median_target""")
def matched_sample_check(t):
    rows = t.prompts().select("doc_id", "n_chars", "toxic")
    target = rows.filter("toxic = 1")
    matched = sampling.sample_matched(target, rows.filter("toxic = 0").drop("toxic"), "n_chars", "doc_id")
    one = matched.agg(F.struct(F.count("*").alias("n"), F.median("n_chars").alias("m"))).scalar()
    return target.agg(F.count("*").alias("n_target"), r6(F.median("n_chars")).alias("median_target")).select(
        one["n"].alias("n_matched"), "n_target", r6(one["m"]).alias("median_matched"), "median_target"
    )


def sql_quota(classes: str, label: str, kept: str) -> str:
    """Largest-remainder quotas of `kept` rows over a table of class sizes."""
    return f"""SELECT {label}, fl + CAST(row_number() OVER (ORDER BY round(ex - fl, 9) DESC, {label}) <= draws - sum(fl) OVER () AS INTEGER) AS quota
  FROM (SELECT *, floor(ex) AS fl FROM (SELECT {label}, draws, CAST(draws * n AS DOUBLE) / total AS ex
    FROM (SELECT *, {kept} AS draws FROM (SELECT *, sum(n) OVER () AS total FROM ({classes})))))"""


def sql_split(source: str, label: str, held: float, seed: int, first: str, second: str) -> str:
    sizes = f"SELECT {label}, count(*) AS n FROM {source} GROUP BY {label}"
    return f"""
  SELECT s.*, CASE WHEN k <= quota THEN '{first}' ELSE '{second}' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {key('doc_id', seed)}, doc_id) AS k FROM {source}) s
  JOIN ({sql_quota(sizes, label, f'total - ceil(total * {held})')}) q USING ({label})"""


def sql_three_way(source: str, label: str, seed: int) -> str:
    sizes = f"SELECT {label}, count(*) AS n FROM {source} GROUP BY {label}"
    rest = sql_quota(sizes, label, "total - ceil(total * 0.2)")
    train = sql_quota(f"SELECT {label}, quota AS n FROM ({rest})", label, "total - ceil(total * 0.25)")
    return f"""
  SELECT doc_id, {label}, CASE WHEN k <= t.quota THEN 'train' WHEN k <= r.quota THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {key('doc_id', seed)}, doc_id) AS k FROM {source}) s
  JOIN ({rest}) r USING ({label}) JOIN ({train}) t USING ({label})"""


@query("split_stratified", f"""
WITH {PROMPTS}, rows AS (SELECT doc_id, toxic AS harm FROM prompts), s AS ({sql_split('rows', 'harm', 0.15, 42, 'train', 'val')})
SELECT doc_id, harm, split FROM s""")
def split_stratified(t):
    rows = t.prompts().select("doc_id", F.col("toxic").alias("harm"))
    return sampling.stratified_split(rows, "harm", "doc_id", 0.15, seed=42)


@query("split_three_way", f"""
WITH {PROMPTS}, rows AS (SELECT doc_id, toxic AS harm FROM prompts),
every AS ({sql_three_way('rows', 'harm', 1234)})
SELECT split, count(*) AS n, round(avg(harm), 6) AS harm_rate, CAST(sum(doc_id) AS BIGINT) AS id_sum FROM every GROUP BY split""")
def split_three_way(t):
    rows = t.prompts().select("doc_id", F.col("toxic").alias("harm"))
    splits = sampling.three_way_split(rows, "harm", "doc_id")
    sums = splits.groupBy("split").agg(F.sum("doc_id").alias("id_sum"))
    return quality.split_summary(splits).withColumn("harm_rate", r6("harm_rate")).join(sums, "split")


@query("assign_ids", """
SELECT 'train' AS part, o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS conversation_id FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'test', o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 + (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P')
FROM orders WHERE o_orderstatus = 'P'""")
def assign_ids(t):
    orders = t("orders").select("o_orderkey", "o_orderstatus")
    train = sampling.assign_ids(orders.filter("o_orderstatus <> 'P'"), "o_orderkey")
    test = sampling.assign_ids(orders.filter("o_orderstatus = 'P'"), "o_orderkey", offset=sampling.next_free_id(train))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("part", "o_orderkey", "conversation_id")


SIZES = (20, 50, 100, 1000000000)


def sql_learning_curve() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT harm, {size} AS size, fl + CAST(row_number() OVER (ORDER BY round(ex - fl, 9) DESC, harm) <= draws - sum(fl) OVER () AS INTEGER) AS quota
  FROM (SELECT *, floor(ex) AS fl FROM (SELECT harm, least({size}, total) AS draws, CAST(least({size}, total) * n AS DOUBLE) / total AS ex
    FROM (SELECT harm, count(*) AS n, sum(count(*)) OVER () AS total FROM rows GROUP BY harm)))"""
        for size in SIZES
    )
    return f"""
WITH {PROMPTS}, rows AS (SELECT doc_id, toxic AS harm FROM prompts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY harm ORDER BY {key('doc_id')}, doc_id) AS k FROM rows),
quotas AS ({parts})
SELECT size, doc_id, harm FROM ranked JOIN quotas USING (harm) WHERE k <= quota"""


@query("learning_curve_subsets", sql_learning_curve())
def learning_curve_subsets(t):
    rows = t.prompts().select("doc_id", F.col("toxic").alias("harm"))
    return sampling.learning_curve(rows, "harm", "doc_id", SIZES).select("size", "doc_id", "harm")
