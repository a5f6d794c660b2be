"""Queries that run whole chains."""

from pyspark.sql import functions as F

from convlens import constants as K
from convlens import session
from convlens.catalog.base import CHATS, DRAWS, MESSAGES, PROMPTS, SQL_WORD, query, r6
from convlens.catalog.samples import key, sql_split, sql_three_way
from convlens.catalog.texts import sql_clean, sql_list
from convlens.functions import columns as B
from convlens.functions import conversation as C
from convlens.functions import text as TX
from convlens.operators import metrics, quality
from convlens.plans import corpora
from convlens.sources import readers


@query("harm_by_group", f"""
WITH {PROMPTS}, c AS (SELECT quality = 0 AS adversarial, toxic AS harm, {sql_clean('text')} AS cleaned FROM prompts),
s AS (SELECT *, len(regexp_extract_all(cleaned, '{SQL_WORD}')) AS n_words FROM c)
SELECT adversarial, harm, count(*) AS n, CAST(sum(n_words) AS BIGINT) AS n_words,
       round(avg(CAST(CAST(n_words >= 400 AS INTEGER) = harm AS INTEGER)), 6) AS accuracy
FROM s GROUP BY adversarial, harm""")
def harm_by_group(t):
    rows = t.prompt_texts().select(
        (F.col("quality") == 0).alias("adversarial"), B.equals(F.col("toxic"), 1).alias("harm"),
        TX.clean_text(F.col("text")).alias("cleaned"),
    ).withColumn("n_words", TX.word_count(F.col("cleaned")))
    rows = rows.withColumn("correct", B.correct((F.col("n_words") >= 400).cast("int"), F.col("harm")))
    sizes = rows.groupBy("adversarial", "harm").agg(
        F.count("*").alias("n"), F.sum("n_words").alias("n_words"), r6(F.avg(F.col("correct").cast("int"))).alias("accuracy")
    )
    return sizes


def single_raw(t, quality: int):
    return t.prompt_texts().filter(F.col("quality") == quality).select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("prompt"),
        F.when(F.col("n_chars") > 500, F.col("source")).alias("response"),
        F.when(F.col("toxic") == 1, "harmful").otherwise("unharmful").alias("prompt_harm_label"),
        F.when(F.col("lang") == "fr", "harmful").alias("response_harm_label"),
        F.col("source").alias("subcategory"), (F.col("lang") == "en").alias("adversarial"),
    )


@query("singleturn_corpus", f"""
WITH {PROMPTS}, f AS (
  SELECT *, row_number() OVER (PARTITION BY quality, text ORDER BY doc_id) AS rn FROM prompts),
l AS (SELECT doc_id, quality, text, CASE WHEN n_chars > 500 THEN source ELSE '' END AS response,
             CAST(toxic = 1 OR lang = 'fr' AS INTEGER) AS harm FROM f WHERE rn = 1),
train AS (SELECT doc_id, harm FROM l WHERE quality = 1), s AS ({sql_split('train', 'harm', 0.2, 1234, 'train', 'val')}),
e AS (SELECT l.*, coalesce(s.split, 'test') AS split, '__ROLE_USER__ ' || text || ' __ROLE_ASSISTANT__ ' || response AS conversation,
             len(regexp_extract_all(text, '{SQL_WORD}')) + len(regexp_extract_all(response, '{SQL_WORD}')) AS n_words
      FROM l LEFT JOIN s USING (doc_id))
SELECT CASE WHEN split = 'test' THEN doc_id + (SELECT max(doc_id) + 1 FROM prompts WHERE quality = 1) ELSE doc_id END AS conversation_id,
       conversation, {sql_clean('conversation')} AS conversation_proc, n_words, harm, split FROM e""")
def singleturn_corpus(t):
    return corpora.single_turn(single_raw(t, 1), single_raw(t, 0)).drop("row_id")


NAMED = f"""{CHATS},
tagged AS (SELECT conv_id, turn, role, content FROM messages WHERE conv_id IN (SELECT conversation_id FROM chats WHERE redacted)),
{DRAWS},
pieces AS (
  SELECT conv_id, turn, unnest(regexp_extract_all(content, 'NAME_[0-9]+|[^N]+|N')) AS piece,
         generate_subscripts(regexp_extract_all(content, 'NAME_[0-9]+|[^N]+|N'), 1) AS pos FROM tagged),
replaced AS (
  SELECT p.conv_id, p.turn, string_agg(coalesce(d.name, p.piece), '' ORDER BY pos) AS content
  FROM pieces p LEFT JOIN drawn d ON p.conv_id = d.conv_id AND p.piece = d.token GROUP BY p.conv_id, p.turn),
named AS (SELECT m.conv_id, m.turn, m.role, coalesce(r.content, m.content) AS content
          FROM messages m LEFT JOIN replaced r ON m.conv_id = r.conv_id AND m.turn = r.turn)"""


@query("multiturn_corpus", f"""
WITH {NAMED},
cats AS (SELECT conv_id, concat_ws(',', CASE WHEN bool_or(flagged AND harassment) THEN 'harassment' END,
     CASE WHEN bool_or(flagged AND self_harm) THEN 'self-harm' END, CASE WHEN bool_or(flagged AND violence) THEN 'violence' END) AS flagged_categories
  FROM messages GROUP BY conv_id),
flat AS (SELECT n.conv_id, string_agg('__ROLE_' || upper(n.role) || '__ ' || n.content, ' ' ORDER BY n.turn) AS conversation,
                CAST(sum(len(regexp_extract_all(n.content, '{SQL_WORD}'))) AS BIGINT) AS n_words FROM named n GROUP BY n.conv_id),
k AS (SELECT conv_id, conversation, n_words, CAST(any_flagged AS INTEGER) AS harm FROM flat JOIN chats ON conv_id = conversation_id
      WHERE language = 'English' AND turn >= 2 AND n_words < 6000),
r AS (SELECT *, row_number() OVER (PARTITION BY harm ORDER BY {key('conv_id')}, conv_id) AS rn FROM k)
SELECT conv_id AS conversation_id, conversation, {sql_clean('conversation')} AS conversation_proc, n_words, harm, flagged_categories
FROM r JOIN cats USING (conv_id) WHERE rn <= 10""")
def multiturn_corpus(t):
    table = corpora.multi_turn(t.chats(), t.names(), sample_size=20, min_turns=2, complete=False)
    return table.withColumns(
        {"flagged_categories": F.array_join("flagged_categories", ","), "n_words": F.col("n_words").cast("bigint")}
    )


@query("length_matched_corpus", f"""
WITH {NAMED},
pr AS (SELECT u.conv_id, u.turn, u.text AS u, b.text AS b FROM conversations u JOIN conversations b ON u.conv_id = b.conv_id AND b.turn = u.turn + 1
         WHERE u.role = 'user' AND b.role = 'assistant'),
am AS (SELECT conv_id, turn, 0 AS side, 'user' AS role, u AS content FROM pr UNION ALL SELECT conv_id, turn, 1, 'assistant', b FROM pr),
attack AS (SELECT 'a' || conv_id AS conversation_id, true AS harm, CAST(sum(length(content)) AS BIGINT) AS n_chars,
                  CAST(to_json(list({{'role': role, 'content': content}} ORDER BY turn, side)) AS VARCHAR) AS conversation FROM am GROUP BY conv_id),
benign AS (SELECT CAST(n.conv_id AS VARCHAR) AS conversation_id, false AS harm, CAST(sum(length(n.content)) AS BIGINT) AS n_chars,
                  CAST(to_json(list({{'role': n.role, 'content': n.content}} ORDER BY n.turn)) AS VARCHAR) AS conversation
           FROM named n JOIN chats ON n.conv_id = conversation_id WHERE language = 'English' AND chats.turn >= 2 AND NOT any_flagged GROUP BY n.conv_id),
ends AS (SELECT CAST(min(n_chars) AS DOUBLE) AS lo, CAST(max(n_chars) AS DOUBLE) AS hi FROM attack),
bins AS (SELECT i AS bin, CASE WHEN i = 1 THEN lo - 0.001 ELSE lo + CAST(i - 1 AS DOUBLE) * ((hi - lo) / 20) END AS l,
                CASE WHEN i = 20 THEN hi ELSE lo + CAST(i AS DOUBLE) * ((hi - lo) / 20) END AS r FROM range(1, 21) AS s(i), ends),
need AS (SELECT bin, count(*) AS quota FROM attack JOIN bins ON n_chars > l AND n_chars <= r GROUP BY bin),
pool AS (SELECT b.*, bin, row_number() OVER (PARTITION BY bin ORDER BY {key('conversation_id')}, conversation_id) AS rn
         FROM benign b JOIN bins ON n_chars > l AND n_chars <= r)
SELECT conversation_id, conversation, harm, n_chars FROM attack
UNION ALL SELECT conversation_id, conversation, harm, n_chars FROM pool JOIN need USING (bin) WHERE rn <= quota""")
def length_matched_corpus(t):
    attacks = t.pairs().select(F.concat(F.lit("a"), "conv_id").alias("id"), "history")
    chats = t.chats().withColumn("conversation_id", F.col("conversation_id").cast("string"))
    table = corpora.length_matched(attacks, chats, t.names())
    return table.withColumn("n_chars", F.col("n_chars").cast("bigint"))


def sql_prepared(text: str) -> str:
    return (f"array_to_string(list_filter(regexp_extract_all({sql_clean(text)}, '{SQL_WORD}'), "
            f"lambda x: x NOT IN {sql_list(K.ENGLISH_STOP)}), ' ')")


def sql_balanced(source: str, size: str) -> str:
    return f"""SELECT doc_id, harm FROM (SELECT *, row_number() OVER (PARTITION BY harm ORDER BY {key('doc_id')}, doc_id) AS rn FROM {source})
  WHERE rn <= CASE WHEN harm = 1 THEN ({size}) // 2 + ({size}) % 2 ELSE ({size}) // 2 END"""


@query("two_corpora_splits", f"""
WITH {MESSAGES}, {PROMPTS},
mt AS (SELECT conv_id AS doc_id, CAST(bool_or(flagged) AS INTEGER) AS harm, string_agg(content, ' ' ORDER BY turn) AS text FROM messages GROUP BY conv_id),
m AS (SELECT doc_id, harm, {sql_prepared('text')} AS conversation FROM mt),
st AS (SELECT doc_id, toxic AS harm, quality, {sql_prepared("text || ' '")} AS conversation FROM prompts),
mk AS (SELECT doc_id, harm FROM m WHERE conversation <> ''),
tr AS (SELECT doc_id, harm FROM st WHERE quality = 1 AND conversation <> ''),
te AS (SELECT doc_id, harm FROM st WHERE quality = 0 AND conversation <> ''),
ms AS ({sql_three_way('mk', 'harm', 1234)}),
fit AS ({sql_balanced('tr', "SELECT count(*) FROM ms WHERE split <> 'test'")}),
fs AS ({sql_split('fit', 'harm', 0.25, 1234, 'train', 'val')}),
ts AS ({sql_balanced('te', "SELECT count(*) FROM ms WHERE split = 'test'")})
SELECT 'multi' AS corpus, split, doc_id AS conversation_id, conversation, ms.harm AS harm FROM ms JOIN m USING (doc_id)
UNION ALL SELECT 'single', split, doc_id, conversation, fs.harm FROM fs JOIN st USING (doc_id)
UNION ALL SELECT 'single', 'test', doc_id, conversation, ts.harm FROM ts JOIN st USING (doc_id)""")
def two_corpora_splits(t):
    chats = t.chats()
    multi = chats.select("conversation_id", "conversation", C.any_flagged(F.col("openai_moderation")).cast("int").alias("harm"))
    single = t.prompt_texts().select(
        F.col("doc_id").alias("conversation_id"), C.from_prompt(F.col("text"), F.lit(None).cast("string")).alias("conversation"),
        F.col("toxic").alias("harm"), "quality",
    )
    return corpora.two_corpora(multi, single.filter("quality = 1"), single.filter("quality = 0"), complete=False)


@query("error_analysis")
def error_analysis(t):
    table = session.stage(corpora.single_turn(single_raw(t, 1), single_raw(t, 0)))
    both = single_raw(t, 1).unionByName(single_raw(t, 0)).select("row_id", "adversarial", "subcategory")
    meta = table.select("row_id", "conversation_id").join(both, "row_id").drop("row_id")
    meta = session.stage(meta)
    parts = corpora.error_analysis(table, meta)
    return parts["by_subcategory"]


@query("row_ids", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) + 99 AS row_id FROM documents")
def row_ids(t):
    return readers.with_row_ids(t.spark, f"{t.folder}/documents.parquet", offset=100).select("doc_id", "row_id")


# Files hold their rows in the order of ids.
EARLY = """
WITH r AS (
  SELECT doc_id, coalesce(lang = 'en', false) AS english, coalesce(lang = 'en' AND n_chars >= 800, false) AS long,
         coalesce(lang = 'en' AND n_chars >= 800 AND NOT contains(text, '###'), false) AS clean FROM documents),
k AS (SELECT *, count(*) FILTER (clean) OVER (ORDER BY doc_id) AS upto FROM r),
s AS (SELECT * FROM k WHERE upto < 40 OR (upto = 40 AND clean))"""


def early_scan(t):
    conditions = {"english": F.col("lang") == "en", "long": F.col("n_chars") >= 800, "clean": ~F.contains("text", F.lit("###"))}
    return readers.scan_until(t.spark, f"{t.folder}/documents.parquet", conditions, 40)


@query("early_scan_rows", f"{EARLY} SELECT doc_id, lang, source FROM s JOIN documents USING (doc_id) WHERE clean")
def early_scan_rows(t):
    return early_scan(t)[0].select("doc_id", "lang", "source")


@query("early_scan_report", f"""{EARLY}
SELECT count(*) AS scanned, count(*) FILTER (english) AS english, count(*) FILTER (long) AS long, count(*) FILTER (clean) AS clean,
       count(*) FILTER (clean) AS kept FROM s""")
def early_scan_report(t):
    return early_scan(t)[1]


# A second build of the documents with rows changed, dropped, added and repeated.
@query("rebuilt_difference", """
WITH other AS (
  SELECT doc_id, CASE WHEN doc_id % 101 = 7 THEN text || '.' ELSE text END AS text, lang FROM documents WHERE doc_id % 211 <> 3
  UNION ALL SELECT doc_id + 1000000000, text, lang FROM documents WHERE doc_id % 307 = 5
  UNION ALL SELECT doc_id, text, lang FROM documents WHERE doc_id % 401 = 11),
a AS (SELECT doc_id, count(*) AS n, string_agg(concat_ws('|', text, lang), '~' ORDER BY text, lang) AS v FROM documents GROUP BY doc_id),
b AS (SELECT doc_id, count(*) AS n, string_agg(concat_ws('|', text, lang), '~' ORDER BY text, lang) AS v FROM other GROUP BY doc_id)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'left' WHEN a.doc_id IS NULL THEN 'right' ELSE 'changed' END AS status
FROM a FULL JOIN b ON a.doc_id = b.doc_id WHERE a.v IS DISTINCT FROM b.v""")
def rebuilt_difference(t):
    docs = t("documents").select("doc_id", "text", "lang")
    changed = docs.withColumn("text", F.when(F.col("doc_id") % 101 == 7, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    other = changed.filter("doc_id % 211 <> 3").unionByName(
        docs.filter("doc_id % 307 = 5").withColumn("doc_id", F.col("doc_id") + 1000000000)
    ).unionByName(docs.filter("doc_id % 401 = 11"))
    return quality.table_difference(docs, other, "doc_id")[0]
