"""Registry, table access, and the roles the given tables play."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.functions import conversation as C
from convlens.sources import readers

REGISTRY: dict = {}


def query(name: str, sql: str | None = None):
    def register(run):
        REGISTRY[name] = (run, sql)
        return run

    return register


def r6(column: Column | str) -> Column:
    return F.round(column, 6)


class Tables:
    """The given tables, and the corpora derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return readers.read_parquet(self.spark, f"{self.folder}/{name}.parquet")

    def texts(self, name: str) -> DataFrame:
        """A table read for work on its texts."""
        return readers.spread(self(name))

    def prompts(self) -> DataFrame:
        """Labelled single-turn prompts."""
        return self("documents").join(self("labels"), "doc_id")

    def prompt_texts(self) -> DataFrame:
        """The same, read for work on the texts."""
        return self.texts("documents").join(self("labels"), "doc_id")

    def scored(self) -> DataFrame:
        """Prompts with a score, tied on purpose, and its prediction."""
        score = F.round(F.least("n_chars", F.lit(5000)) / 5000.0, 2)
        return self.prompts().select(
            "doc_id", "source", "lang", "n_chars", F.col("toxic").alias("harm"),
            (F.col("quality") == 0).alias("adversarial"), score.alias("score"),
            (score >= 0.5).cast("int").alias("pred"),
        )

    def nested(self, text: Column | str = "text") -> DataFrame:
        """(conv_id, conversation): the messages of each conversation in order.

        A conversation is one record of the data model, so its messages are
        brought together here, as they already are in nested sources.
        """
        text = F.col(text) if isinstance(text, str) else text
        one = F.struct("turn", F.col("role"), text.alias("content"))
        listed = self("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("_m"))
        return listed.select("conv_id", F.transform("_m", lambda m: C.message(m["role"], m["content"])).alias("conversation"))

    def chats(self) -> DataFrame:
        """Conversations with the columns of a moderated chat corpus."""
        text, low = F.col("text"), F.lower("text")
        flags = F.create_map(
            F.lit("harassment"), low.contains("hate"),
            F.lit("self-harm"), low.contains("stst"),
            F.lit("violence"), low.contains("blewh"),
        )
        one = F.struct(
            "turn", "role", tagged_text().alias("content"),
            (low.contains("hate") | (F.length(text) > 1200)).alias("flagged"), flags.alias("categories"),
            F.concat(F.lit(" "), low, F.lit(" ")).contains(" the ").alias("english"), (F.length(text) < 40).alias("short"),
        )
        listed = self("conversations").groupBy("conv_id").agg(F.collect_list(one).alias("_m"))
        ordered = F.array_sort(
            F.col("_m"), lambda a, b: F.when(a["turn"] < b["turn"], -1).when(a["turn"] > b["turn"], 1).otherwise(0)
        )
        return listed.withColumn("_m", ordered).select(
            F.col("conv_id").alias("conversation_id"),
            F.concat(F.lit("model-"), F.substring(F.get("_m", F.lit(0))["content"], 10, 1)).alias("model"),
            F.transform("_m", lambda m: C.message(m["role"], m["content"])).alias("conversation"),
            F.size(F.filter("_m", lambda m: m["role"] == "user")).alias("turn"),
            F.when(F.exists("_m", lambda m: m["english"]), "English").otherwise("other").alias("language"),
            F.transform("_m", lambda m: F.struct(m["flagged"].alias("flagged"), m["categories"].alias("categories"))).alias("openai_moderation"),
            F.exists("_m", lambda m: m["short"]).alias("redacted"),
        )

    def chat_facts(self) -> DataFrame:
        """What the filters ask of the same chats, from message rows: no text is grouped."""
        text, low = F.col("text"), F.lower("text")
        bad = low.contains("hate") | low.contains("stst") | low.contains("blewh")
        rows = self.texts("conversations").select(
            F.col("conv_id").alias("conversation_id"), "turn", F.substring(tagged_text(), 10, 1).alias("_m"), (F.col("role") == "user").alias("_u"),
            F.concat(F.lit(" "), low, F.lit(" ")).contains(" the ").alias("_e"), bad.alias("_b"), (F.length(text) < 40).alias("_s"),
        )
        return rows.groupBy("conversation_id").agg(
            F.concat(F.lit("model-"), F.min_by("_m", "turn")).alias("model"), F.count_if("_u").alias("n_user_turns"),
            F.when(F.bool_or("_e"), "English").otherwise("other").alias("language"), (~F.bool_or("_b")).alias("clean"), F.bool_or("_s").alias("redacted"),
        )

    def names(self) -> DataFrame:
        """Nations as a name dictionary."""
        return self("nation").select(
            F.col("n_nationkey").cast("bigint").alias("Id"), F.col("n_name").alias("Name"),
            (F.col("n_nationkey") + 1).cast("bigint").alias("Count"),
        )

    def pairs(self) -> DataFrame:
        """(conv_id, history): each user message with the assistant message after it."""
        messages = self("conversations")
        user = messages.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("user"))
        bot = messages.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("bot"))
        both = user.join(bot, ["conv_id", "turn"])
        listed = F.array_sort(F.collect_list(F.struct("turn", "user", "bot")))
        return both.groupBy("conv_id").agg(listed.alias("_p")).select(
            "conv_id", F.transform("_p", lambda p: F.struct(p["user"].alias("user"), p["bot"].alias("bot"))).alias("history")
        )


def tagged_text() -> Column:
    """Message text led by a redacted-name token."""
    return F.concat(F.lit("[NAME_"), (F.col("turn") % 3 + 1).cast("string"), F.lit("] "), F.col("text"))


# The same white space spelt out for the SQL side.
SQL_SPACE = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SQL_WORD = f"[^{SQL_SPACE}]+"

# SQL counterparts of the corpora above, as common table expressions.
PROMPTS = "prompts AS (SELECT * FROM documents JOIN labels USING (doc_id))"

SCORED = PROMPTS + """, scored AS (
  SELECT doc_id, source, lang, n_chars, toxic AS harm, quality = 0 AS adversarial, score,
         CAST(score >= 0.5 AS INTEGER) AS pred
  FROM (SELECT *, round(least(n_chars, 5000) / 5000.0, 2) AS score FROM prompts))"""

TAGGED = "'[NAME_' || CAST(turn % 3 + 1 AS VARCHAR) || '] ' || text"

MESSAGES = f"""messages AS (
  SELECT conv_id, turn, role, {TAGGED} AS content, length(text) < 40 AS short,
         contains(lower(text), 'hate') OR length(text) > 1200 AS flagged,
         contains(lower(text), 'hate') AS harassment,
         contains(' ' || lower(text) || ' ', ' the ') AS english,
         contains(lower(text), 'stst') AS self_harm,
         contains(lower(text), 'blewh') AS violence
  FROM conversations)"""

CHATS = MESSAGES + """, chats AS (
  SELECT conv_id AS conversation_id,
         'model-' || substr(first(content ORDER BY turn), 10, 1) AS model,
         CASE WHEN bool_or(english) THEN 'English' ELSE 'other' END AS language,
         count(*) FILTER (role = 'user') AS turn,
         bool_or(flagged) AS any_flagged,
         NOT bool_or(harassment OR self_harm OR violence) AS clean,
         bool_or(short) AS redacted
  FROM messages GROUP BY conv_id)"""

# Name draws: intervals over the dictionary in digest order, then one draw per token.
DRAWS = """dictionary AS (
  SELECT n_name AS name, n_nationkey + 1 AS w,
         sum(n_nationkey + 1) OVER (ORDER BY md5(n_name), n_name) AS cum,
         sum(n_nationkey + 1) OVER () AS total
  FROM nation),
intervals AS (SELECT name, CAST(cum - w AS DOUBLE) / total AS lo, CAST(cum AS DOUBLE) / total AS hi FROM dictionary),
tokens AS (SELECT DISTINCT conv_id, unnest(regexp_extract_all(content, 'NAME_[0-9]+')) AS token FROM tagged),
drawn AS (
  SELECT conv_id, token, name
  FROM (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', conv_id, token, '1234')), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM tokens)
  JOIN intervals ON lo <= u AND u < hi)"""
