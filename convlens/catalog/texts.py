"""Queries over text: cleaning, counts, tokens, n-grams, deduplication."""

from pyspark.sql import functions as F

from convlens import constants as K
from convlens.catalog.base import PROMPTS, SQL_SPACE, SQL_WORD, query, r6
from convlens.functions import text as TX
from convlens.operators import dedup, ngrams, similarity


def sql_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def sql_clean(text: str) -> str:
    flat = f"regexp_replace(replace({text}, chr(10), ' '), '{K.TAG}', '', 'g')"
    faces = f"replace(array_to_string(regexp_extract_all({flat}, '{K.EMOTICON}'), ' '), '-', '')"
    return f"regexp_replace(lower({flat}), '{K.NON_WORD}', ' ', 'g') || {faces}"


@query("clean_text", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def clean_text(t):
    return t.texts("documents").select("doc_id", TX.clean_text(F.col("text")).alias("cleaned"))


@query("clean_pages", f"SELECT page_id, {sql_clean('html')} AS cleaned FROM pages")
def clean_pages(t):
    return t.texts("pages").select("page_id", TX.clean_text(F.col("html")).alias("cleaned"))


@query("clean_no_stopwords", f"""
WITH c AS (SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents),
w AS (SELECT doc_id, array_to_string(list_filter(regexp_extract_all(cleaned, '{SQL_WORD}'),
             lambda x: x NOT IN {sql_list(K.ENGLISH_STOP)}), ' ') AS kept FROM c)
SELECT doc_id, kept FROM w WHERE regexp_matches(kept, '[^{SQL_SPACE}]')""")
def clean_no_stopwords(t):
    cleaned = t.texts("documents").select("doc_id", TX.clean_text(F.col("text")).alias("_c"))
    kept = cleaned.select("doc_id", TX.held(TX.without_stop_words(F.col("_c"))).alias("kept"))
    return kept.filter(~TX.is_blank(F.col("kept")))


@query("word_char_counts", f"""
SELECT doc_id, len(regexp_extract_all(text, '{SQL_WORD}')) AS n_words, length(text) AS n_chars,
       CASE WHEN length(text) = 0 THEN 'unknown'
            WHEN len(regexp_extract_all(text, '{K.CJK}')) / length(text) > 0.05 THEN 'zh' ELSE 'en' END AS guess
FROM documents""")
def word_char_counts(t):
    text = F.col("text")
    return t.texts("documents").select(
        "doc_id", TX.word_count(text).alias("n_words"), TX.char_count(text).alias("n_chars"),
        TX.guess_language(text).alias("guess"),
    )


TOKENS = {
    "letters": (K.LETTERS_TOKEN, K.LETTERS_STOP, 0),
    "lower": (K.LOWER_TOKEN, K.LOWER_STOP, 2),
}


def sql_tokens(kind: str) -> str:
    pattern, stop, longer = TOKENS[kind]
    quoted = pattern.replace("'", "''")
    return (f"list_filter(regexp_extract_all(lower(text), '{quoted}'), "
            f"lambda x: length(x) > {longer} AND x NOT IN {sql_list(stop)})")


@query("top_unigrams_by_class", f"""
WITH {PROMPTS}, w AS (SELECT toxic AS harm, unnest({sql_tokens('letters')}) AS gram FROM prompts),
n AS (SELECT harm, gram, count(*) AS n FROM w GROUP BY harm, gram),
r AS (SELECT *, row_number() OVER (PARTITION BY harm ORDER BY n DESC, gram) AS "rank" FROM n)
SELECT harm, gram, n, "rank" FROM r WHERE "rank" <= 20""")
def top_unigrams_by_class(t):
    rows = t.prompt_texts().withColumnRenamed("toxic", "harm")
    top = ngrams.top_grams(rows, TX.letter_tokens(F.col("text")), "harm", 1, 20)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


NGRAM_TABLE = f"""
WITH {PROMPTS}, k AS (SELECT toxic AS harm, {sql_tokens('lower')} AS w FROM prompts),
g AS (SELECT harm, 1 AS size, unnest(w) AS gram FROM k
      UNION ALL
      SELECT harm, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM k),
n AS (SELECT harm, size, gram, count(*) AS n FROM g GROUP BY harm, size, gram),
r AS (SELECT *, row_number() OVER (PARTITION BY harm, size ORDER BY n DESC, gram) AS "rank" FROM n)
SELECT "rank",
       coalesce(max(gram || ' (' || n || ')') FILTER (harm = 1 AND size = 1), '') AS harmful_1,
       coalesce(max(gram || ' (' || n || ')') FILTER (harm = 0 AND size = 1), '') AS unharmful_1,
       coalesce(max(gram || ' (' || n || ')') FILTER (harm = 1 AND size = 2), '') AS harmful_2,
       coalesce(max(gram || ' (' || n || ')') FILTER (harm = 0 AND size = 2), '') AS unharmful_2
FROM r WHERE "rank" <= 25 GROUP BY "rank"
"""


@query("ngram_table", NGRAM_TABLE)
def ngram_table(t):
    rows = t.prompt_texts().withColumnRenamed("toxic", "harm")
    lists = {}
    for n in (1, 2):
        top = ngrams.top_grams(rows, TX.lower_tokens(F.col("text")), "harm", n, 25)
        lists[f"harmful_{n}"] = top.filter("harm = 1")
        lists[f"unharmful_{n}"] = top.filter("harm = 0")
    return ngrams.side_by_side(lists).withColumn("rank", F.col("rank").cast("bigint"))


@query("top_bigrams_by_class", f"""
WITH {PROMPTS}, k AS (SELECT toxic AS harm, {sql_tokens('letters')} AS w FROM prompts),
g AS (SELECT harm, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM k),
n AS (SELECT harm, gram, count(*) AS n FROM g GROUP BY harm, gram),
r AS (SELECT *, row_number() OVER (PARTITION BY harm ORDER BY n DESC, gram) AS "rank" FROM n)
SELECT harm, gram, n, "rank" FROM r WHERE "rank" <= 20""")
def top_bigrams_by_class(t):
    rows = t.prompt_texts().withColumnRenamed("toxic", "harm")
    top = ngrams.top_grams(rows, TX.letter_tokens(F.col("text")), "harm", 2, 20)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query("vocab_by_corpus", f"""
SELECT lang, count(DISTINCT word) AS vocabulary
FROM (SELECT lang, unnest(regexp_extract_all(text, '{SQL_WORD}')) AS word FROM documents) GROUP BY lang""")
def vocab_by_corpus(t):
    return ngrams.vocabulary_size(t.texts("documents"), "text", "lang")


@query("truncate_tokens", f"""
SELECT doc_id, array_to_string(list_slice(w, greatest(len(w) - 127, 1), len(w)), ' ') AS last_tokens,
       array_to_string(list_slice(w, 1, 128), ' ') AS first_tokens, 'classification: ' || text AS prefixed
FROM (SELECT doc_id, text, regexp_extract_all(text, '{SQL_WORD}') AS w FROM documents)""")
def truncate_tokens(t):
    rows = t.texts("documents").select("doc_id", "text", TX.words(F.col("text")).alias("_w"))
    w = F.col("_w")
    return rows.select(
        "doc_id", F.array_join(TX.last_tokens(w, 128), " ").alias("last_tokens"),
        F.array_join(TX.first_tokens(w, 128), " ").alias("first_tokens"),
        TX.with_task_prefix(F.col("text")).alias("prefixed"),
    )


@query("dedup_keep_first", """
SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedup_keep_first(t):
    return dedup.keep_first(t.texts("documents"), ["text"], "doc_id").select("doc_id", "source")


@query("dedup_multi_key_nested", """
SELECT doc_id, lang FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, [{'user': text, 'bot': lang}] ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedup_multi_key_nested(t):
    pair = F.array(F.struct(F.col("text").alias("user"), F.col("lang").alias("bot")))
    rows = t.texts("documents").select("doc_id", "lang", pair.alias("history"))
    return dedup.keep_first(rows, ["lang", "history"], "doc_id").select("doc_id", "lang")


def sql_norm(text: str) -> str:
    return (f"lower(regexp_replace(regexp_replace({text}, '[{SQL_SPACE}]+', ' ', 'g'), "
            f"'^[{SQL_SPACE}]+|[{SQL_SPACE}]+$', '', 'g'))")


@query("dedup_cross_source", f"""
WITH {PROMPTS}, seen AS (
  SELECT {sql_norm('text')} AS k FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
  UNION SELECT {sql_norm('text')} FROM benchmark
  UNION SELECT {sql_norm('text')} FROM conversations WHERE role = 'user')
SELECT doc_id, source FROM prompts WHERE {sql_norm('text')} NOT IN (SELECT k FROM seen)""")
def dedup_cross_source(t):
    others = t.texts("documents").join(t("labels"), "doc_id", "left_anti")
    users = t("conversations").filter("role = 'user'")
    kept = dedup.drop_seen(t.prompt_texts(), "text", others, t("benchmark"), users)
    return kept.select("doc_id", "source")


def sql_bands() -> str:
    perms = [dedup.permutation(i) for i in range(64)]
    mins = ", ".join(f"min((h * {a} + {b}) % {dedup.PRIME}) AS p{i}" for i, (a, b) in enumerate(perms))
    keys = ", ".join(
        "struct_pack(band := %d, key := concat_ws('-', %s))" % (b, ", ".join(f"p{b * 8 + r}" for r in range(8)))
        for b in range(8)
    )
    return f"""
words AS (SELECT doc_id, regexp_extract_all({sql_norm('text')}, '{SQL_WORD}') AS w FROM documents),
grams AS (SELECT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
   ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM words),
hashes AS (SELECT DISTINCT doc_id, CAST(('0x' || substr(md5(g), 1, 8)) AS BIGINT) % {dedup.PRIME} AS h FROM grams),
signed AS (SELECT doc_id, {mins} FROM hashes GROUP BY doc_id),
banded AS (SELECT doc_id, unnest([{keys}]) AS k FROM signed)"""


@query("near_dup_minhash", f"""
WITH {sql_bands()}
SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id NOT IN (
  SELECT doc_id FROM banded WHERE k IN (SELECT k FROM banded WHERE doc_id NOT IN (SELECT doc_id FROM labels)))""")
def near_dup_minhash(t):
    others = t.texts("documents").join(t("labels"), "doc_id", "left_anti")
    kept = dedup.drop_near_seen(t.prompt_texts(), "doc_id", "text", others, "doc_id")
    return kept.select("doc_id", "source")


# Every text of the one side against every text of the other.
@query("near_dup_verified", f"""
WITH texts AS (SELECT doc_id, source, doc_id IN (SELECT doc_id FROM labels) AS mine, {sql_norm('text')} AS k FROM documents),
words AS (SELECT k, regexp_extract_all(k, '{SQL_WORD}') AS w FROM (SELECT DISTINCT k FROM texts)),
sets AS (SELECT k, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
   ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words),
items AS (SELECT k, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.k AS k, b.k AS other, count(*) AS shared, any_value(a.n) AS n, any_value(b.n) AS m
  FROM items a JOIN items b USING (g)
  WHERE a.k IN (SELECT k FROM texts WHERE mine) AND b.k IN (SELECT k FROM texts WHERE NOT mine) GROUP BY a.k, b.k),
near AS (SELECT k, count(*) AS n_near, max(shared / (n + m - shared)) AS nearest FROM pairs WHERE shared / (n + m - shared) >= 0.8 - 1e-9 GROUP BY k)
SELECT doc_id, source, coalesce(n_near, 0) AS n_near, round(nearest, 6) AS nearest FROM texts LEFT JOIN near USING (k) WHERE mine""")
def near_dup_verified(t):
    others = t.texts("documents").join(t("labels"), "doc_id", "left_anti")
    marked = similarity.with_near(t.prompt_texts().select("doc_id", "source", "text"), "text", others)
    return marked.select("doc_id", "source", "n_near", r6("nearest").alias("nearest"))


# User turns that no assistant turn resembles, at a similarity low enough for some to be dropped.
@query("near_dup_dropped", f"""
WITH u AS (SELECT DISTINCT conv_id, turn, {sql_norm('text')} AS k FROM conversations WHERE role = 'user'),
o AS (SELECT DISTINCT {sql_norm('text')} AS k FROM conversations WHERE role = 'assistant'),
sets AS (SELECT k, list_distinct(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
   ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) END) AS s
   FROM (SELECT k, regexp_extract_all(k, '{SQL_WORD}') AS w FROM (SELECT k FROM u UNION SELECT k FROM o))),
items AS (SELECT k, len(s) AS n, unnest(s) AS g FROM sets),
near AS (
  SELECT a.k AS k FROM items a JOIN items b USING (g) WHERE a.k IN (SELECT k FROM u) AND b.k IN (SELECT k FROM o)
  GROUP BY a.k, b.k HAVING count(*) >= 0.1 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9)
SELECT conv_id, turn FROM u WHERE k NOT IN (SELECT k FROM near)""")
def near_dup_dropped(t):
    talks = t("conversations")
    asked, said = (talks.filter(F.col("role") == r) for r in ("user", "assistant"))
    return similarity.drop_near(asked.select("conv_id", "turn", "text"), "text", said, t=0.1, shingle=3).select("conv_id", "turn")
