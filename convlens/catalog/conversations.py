"""Queries over nested conversations."""

from pyspark.sql import functions as F

from convlens.catalog.base import CHATS, DRAWS, MESSAGES, PROMPTS, SQL_SPACE, SQL_WORD, TAGGED, query, r6, tagged_text
from convlens.catalog.texts import sql_norm
from convlens.functions import columns as B
from convlens.functions import conversation as C
from convlens.functions import text as TX
from convlens.operators import embeddings, messages, names, profile
from convlens.sources import readers


@query("prompt_to_conversation", f"""
WITH {PROMPTS}, built AS (
  SELECT doc_id, text AS u, CASE WHEN quality = 1 THEN source ELSE '' END AS a FROM prompts)
SELECT doc_id, '__ROLE_USER__ ' || u || ' __ROLE_ASSISTANT__ ' || a AS conversation,
       len(regexp_extract_all(u || ' ' || a, '{SQL_WORD}')) AS n_words, 2 AS n_turns
FROM built""")
def prompt_to_conversation(t):
    response = F.when(F.col("quality") == 1, F.col("source"))
    built = t.prompt_texts().select("doc_id", C.from_prompt(F.col("text"), response).alias("c"))
    return built.select(
        "doc_id", C.text_with_roles(F.col("c")).alias("conversation"),
        C.n_words(F.col("c")).alias("n_words"), C.n_turns(F.col("c")).alias("n_turns"),
    )


@query("conversation_text_roles", """
SELECT conv_id, string_agg('__ROLE_' || upper(role) || '__ ' || text, ' ' ORDER BY turn) AS with_roles,
       string_agg(text, ' ' ORDER BY turn) AS without_roles
FROM conversations GROUP BY conv_id""")
def conversation_text_roles(t):
    c = F.col("conversation")
    return t.nested().select("conv_id", C.text_with_roles(c).alias("with_roles"), C.text_without_roles(c).alias("without_roles"))


@query("conversation_lengths", f"""
SELECT conv_id, CAST(sum(len(regexp_extract_all(text, '{SQL_WORD}'))) AS BIGINT) AS n_words,
       CAST(sum(length(text)) AS BIGINT) AS n_chars, count(*) AS n_turns,
       count(*) FILTER (role = 'user') AS n_user_turns
FROM conversations GROUP BY conv_id""")
def conversation_lengths(t):
    return messages.sizes(t.texts("conversations"), "conv_id")


@query("moderation_flags", f"""
WITH {MESSAGES}
SELECT conv_id AS conversation_id, CAST(bool_or(flagged) AS INTEGER) AS harm,
       concat_ws(',', CASE WHEN bool_or(flagged AND harassment) THEN 'harassment' END,
                      CASE WHEN bool_or(flagged AND self_harm) THEN 'self-harm' END,
                      CASE WHEN bool_or(flagged AND violence) THEN 'violence' END) AS flagged_categories,
       CAST(NOT bool_or(harassment OR self_harm OR violence) AS INTEGER) AS clean
FROM messages GROUP BY conv_id""")
def moderation_flags(t):
    text, low = F.col("text"), F.lower("text")
    rows = t.texts("conversations").withColumnRenamed("conv_id", "conversation_id")
    categories = {"harassment": low.contains("hate"), "self-harm": low.contains("stst"), "violence": low.contains("blewh")}
    found = messages.moderation(rows, "conversation_id", low.contains("hate") | (F.length(text) > 1200), categories)
    return found.select(
        "conversation_id", F.col("harm").cast("int").alias("harm"), F.array_join("flagged_categories", ",").alias("flagged_categories"),
        F.col("clean").cast("int").alias("clean"),
    )


@query("user_turn_first_last", f"""
WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role IN ('user', 'human') AND length(text) > 0),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT conv_id, count(text) AS n_user_turns,
       coalesce(length(first(text ORDER BY turn)), 0) AS first_len,
       coalesce(length(last(text ORDER BY turn)), 0) AS last_len,
       regexp_replace(first(text ORDER BY turn) FILTER (regexp_matches(text, '[^{SQL_SPACE}]')),
                      '^[{SQL_SPACE}]+|[{SQL_SPACE}]+$', '', 'g') AS topic_text
FROM ids LEFT JOIN u USING (conv_id) GROUP BY conv_id""")
def user_turn_first_last(t):
    return messages.user_turns(t.texts("conversations"), "conv_id")


@query("topic_texts", f"""
WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user' AND regexp_matches(text, '[^{SQL_SPACE}]') AND length(text) < 120)
SELECT conv_id, regexp_replace(first(text ORDER BY turn), '^[{SQL_SPACE}]+|[{SQL_SPACE}]+$', '', 'g') AS topic_text FROM u GROUP BY conv_id""")
def topic_texts(t):
    """Long turns count as blank here, so that some conversations have none left and are dropped."""
    rows = t.texts("conversations").withColumn("text", F.when(F.length("text") < 120, F.col("text")))
    return messages.topic_texts(rows, "conv_id")


@query("dedup_against_last_turns", f"""
WITH u AS (SELECT conv_id, turn, {sql_norm('text')} AS k FROM conversations WHERE role = 'user' AND length(text) > 0),
seen AS (SELECT last(k ORDER BY turn) AS k FROM u GROUP BY conv_id)
SELECT conv_id, turn FROM u WHERE k NOT IN (SELECT k FROM seen)""")
def dedup_against_last_turns(t):
    talks = t.texts("conversations")
    asked = talks.filter("role = 'user' AND length(text) > 0").select("conv_id", "turn", "text")
    return messages.drop_seen_turns(asked, "text", talks, "conv_id", last=True).select("conv_id", "turn")


TOPICS = ("health", "privacy", "work", "money", "school")


# Token vectors from digests; the first user turn is compared with the words of the topics.
@query("topic_shares", f"""
WITH labels AS (SELECT unnest({list(TOPICS)}) AS label),
u AS (SELECT conv_id, first(text ORDER BY turn) AS text FROM conversations WHERE role = 'user' AND regexp_matches(text, '[^{SQL_SPACE}]') GROUP BY conv_id),
d AS (SELECT range AS i FROM range(8)),
w AS (SELECT conv_id, md5(unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))) AS h FROM u),
v AS (SELECT conv_id, i, CAST(avg(CAST('0x' || substr(h, 4 * i + 1, 4) AS BIGINT) / 65535.0 - 0.5) AS FLOAT) AS x FROM w, d GROUP BY conv_id, i),
l AS (SELECT label, i, CAST(CAST('0x' || substr(md5(label), 4 * i + 1, 4) AS BIGINT) / 65535.0 - 0.5 AS FLOAT) AS y FROM labels, d),
c AS (SELECT conv_id, label, sum(CAST(x AS DOUBLE) * y) / sqrt(sum(CAST(x AS DOUBLE) * x)) / sqrt(sum(CAST(y AS DOUBLE) * y)) AS cos
      FROM v JOIN l USING (i) GROUP BY conv_id, label),
best AS (SELECT conv_id, label FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cos DESC, label) AS k FROM c) WHERE k = 1),
talks AS (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id)
SELECT label AS topic, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct, CAST(sum(turns) AS BIGINT) AS turns
FROM best JOIN talks USING (conv_id) GROUP BY label""")
def topic_shares(t):
    """Topic of each conversation, joined to it, and the topics' distribution."""
    def load():
        return embeddings.HashedTokens(8)

    texts = messages.topic_texts(t.texts("conversations"), "conv_id")
    vectors = embeddings.embed_tokens(texts, "conv_id", "topic_text", load, "hashed")
    named = t.spark.createDataFrame([(x,) for x in TOPICS], "label string")
    labels = embeddings.embed_tokens(named, "label", "label", load, "hashed").select("label", F.col("embedding").alias("vector"))
    near = embeddings.nearest_label(vectors, "embedding", labels, "label").select("conv_id", F.col("nearest").alias("topic"))
    talks = t("conversations").groupBy("conv_id").agg(F.count("*").alias("turns"))
    counts = near.join(talks, "conv_id").groupBy("topic").agg(F.count("*").alias("n"), F.sum("turns").alias("turns"))
    whole = counts.agg(F.sum("n")).scalar()
    return counts.select("topic", "n", F.round(100.0 * F.col("n") / whole, 1).alias("pct"), "turns")


@query("message_role_lengths", """
SELECT role, count(*) AS "count", round(avg(length(text)), 6) AS mean, round(stddev_samp(length(text)), 6) AS std,
       min(length(text)) AS "min", round(quantile_cont(length(text), 0.25), 6) AS p25,
       round(quantile_cont(length(text), 0.5), 6) AS p50, round(quantile_cont(length(text), 0.75), 6) AS p75,
       max(length(text)) AS "max"
FROM conversations GROUP BY role""")
def message_role_lengths(t):
    d = profile.describe(t("conversations").select("role", F.length("text").alias("n")), "n", ["role"])
    return d.select("role", "count", r6("mean").alias("mean"), r6("std").alias("std"), "min",
                    *[r6(c).alias(c) for c in ("p25", "p50", "p75")], "max")


REPLACED = f"""
WITH {MESSAGES}, tagged AS (
  SELECT conv_id, turn, role, content FROM messages
  WHERE conv_id IN (SELECT conv_id FROM messages GROUP BY conv_id HAVING bool_or(short))),
{DRAWS},
pieces AS (
  SELECT conv_id, turn, unnest(regexp_extract_all(content, 'NAME_[0-9]+|[^N]+|N')) AS piece,
         generate_subscripts(regexp_extract_all(content, 'NAME_[0-9]+|[^N]+|N'), 1) AS pos
  FROM tagged),
replaced AS (
  SELECT p.conv_id, p.turn, string_agg(coalesce(d.name, p.piece), '' ORDER BY pos) AS content
  FROM pieces p LEFT JOIN drawn d ON p.conv_id = d.conv_id AND p.piece = d.token GROUP BY p.conv_id, p.turn)
SELECT m.conv_id, m.turn, coalesce(r.content, m.content) AS content
FROM messages m LEFT JOIN replaced r ON m.conv_id = r.conv_id AND m.turn = r.turn"""


@query("replace_names", REPLACED)
def replace_names(t):
    chats = names.replace_in_conversations(t.chats(), "conversation_id", "conversation", t.names(), F.col("redacted"))
    return chats.select(F.col("conversation_id").alias("conv_id"), F.posexplode("conversation").alias("_pos", "m")).select(
        "conv_id", F.col("_pos").cast("bigint").alias("turn"), F.col("m.content").alias("content")
    )


@query("replace_names_by_message", REPLACED)
def replace_names_by_message(t):
    rows = t("conversations").select("conv_id", "turn", tagged_text().alias("content"), (F.length("text") < 40).alias("short"))
    redacted = rows.groupBy("conv_id").agg(F.bool_or("short").alias("redacted"))
    return names.replace_in_messages(
        rows.join(redacted, "conv_id"), "conv_id", "content", t.names(), F.col("redacted")
    ).select("conv_id", "turn", "content")


@query("normalize_pairs", """
WITH p AS (
  SELECT u.conv_id, u.turn, u.text AS u, b.text AS b,
         row_number() OVER (PARTITION BY u.conv_id ORDER BY u.turn) - 1 AS i
  FROM conversations u JOIN conversations b ON u.conv_id = b.conv_id AND b.turn = u.turn + 1
  WHERE u.role = 'user' AND b.role = 'assistant')
SELECT conv_id, 2 * i AS pos, 'user' AS role, u AS content FROM p
UNION ALL SELECT conv_id, 2 * i + 1, 'assistant', b FROM p""")
def normalize_pairs(t):
    pairs = t.pairs()
    direct = pairs.select("conv_id", C.normalize(pairs, "history").alias("c"))
    stored = pairs.select("conv_id", F.to_json("history").alias("history"))
    parsed = stored.select("conv_id", C.normalize(stored, "history").alias("d"))
    both = direct.join(parsed, "conv_id").filter(F.to_json("c") == F.to_json("d"))
    return both.select("conv_id", F.posexplode("c").alias("pos", "m")).select(
        "conv_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content"
    )


@query("role_marker_split", """
WITH c AS (
  SELECT conv_id, string_agg('__ROLE_' || upper(role) || '__ ' || text, ' ' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id)
SELECT conv_id, split_part(text, '__ROLE_ASSISTANT__', 1) AS user_part,
       substr(replace(replace(text, '__ROLE_USER__', chr(10) || 'USER:'), '__ROLE_ASSISTANT__', chr(10) || 'ASSISTANT:'), 1, 200) AS shown
FROM c""")
def role_marker_split(t):
    text = t.nested().select("conv_id", C.text_with_roles(F.col("conversation")).alias("text"))
    return text.select(
        "conv_id", C.user_part(F.col("text")).alias("user_part"),
        B.excerpt(C.readable(F.col("text")), 200).alias("shown"),
    )


@query("filter_funnel", f"""
WITH {CHATS}
SELECT count(*) AS scanned, count(*) FILTER (language = 'English') AS english,
       count(*) FILTER (language = 'English' AND turn >= 2) AS long,
       count(*) FILTER (language = 'English' AND turn >= 2 AND NOT any_bad AND NOT redacted) AS clean,
       least(count(*) FILTER (language = 'English' AND turn >= 2 AND NOT any_bad AND NOT redacted), 5) AS kept
FROM (SELECT *, NOT clean AS any_bad FROM chats)""")
def filter_funnel(t):
    facts = t.chat_facts()
    return readers.funnel(facts, readers.chat_stages(2), 5)


@query("clean_dialogues", f"""
WITH {CHATS}
SELECT conversation_id, model, turn AS n_user_turns FROM chats
WHERE language = 'English' AND turn >= 3 AND clean AND NOT redacted""")
def clean_dialogues(t):
    kept = t.chat_facts().filter(readers.chat_stages(3)["clean"])
    return kept.select("conversation_id", "model", F.col("n_user_turns"))
