"""Expressions over nested conversations: arrays of {role, content} messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convlens import constants as K
from convlens import schemas
from convlens.functions import text as TX


def message(role, content) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def from_prompt(prompt: Column, response: Column) -> Column:
    """Two-message conversation; a missing response becomes empty text."""
    return F.array(
        message("user", prompt), message("assistant", F.coalesce(response, F.lit("")))
    )


def from_pairs(history: Column) -> Column:
    """{user, bot} pairs as user and assistant messages."""
    return F.flatten(
        F.transform(
            history,
            lambda p: F.array(message("user", p["user"]), message("assistant", p["bot"])),
        )
    )


def normalize(df: DataFrame, column: str) -> Column:
    """Any supported conversation column as {role, content} messages.

    The choice is made on the schema: role/content (or from/value, speaker/text)
    arrays, {user, bot} arrays, and JSON text of either of the first and last.
    JSON that holds neither gives null.
    """
    kind = df.schema[column].dataType
    col = F.col(column)
    if isinstance(kind, T.StringType):
        as_messages = F.from_json(col, schemas.CONVERSATION)
        as_pairs = F.from_json(col, schemas.HISTORY)
        return F.when(F.exists(as_pairs, lambda p: p["user"].isNotNull()), from_pairs(as_pairs)).when(
            F.forall(as_messages, lambda m: m["role"].isNotNull()), as_messages
        )
    names = set(kind.elementType.names)
    if {"user", "bot"} <= names:
        return from_pairs(col)
    role = first_name(names, ["role", "from", "speaker"])
    content = first_name(names, ["content", "value", "text"])
    return F.transform(col, lambda m: message(m[role], m[content]))


def first_name(available, candidates: list[str]) -> str:
    """The first candidate that is available; the schema alone is read."""
    found = next((c for c in candidates if c in available), None)
    if found is None:
        raise ValueError(f"none of {candidates} among {sorted(available)}")
    return found


def conversation_column(df: DataFrame) -> str:
    """Name of the column that holds the conversation."""
    return first_name(df.columns, K.CONVERSATION_COLUMNS)


def text_with_roles(conversation: Column) -> Column:
    """One string: each message led by its role marker."""
    return F.array_join(
        F.transform(
            conversation,
            lambda m: F.concat(F.lit("__ROLE_"), F.upper(m["role"]), F.lit("__ "), m["content"]),
        ),
        " ",
    )


def text_without_roles(conversation: Column) -> Column:
    """One string: the contents only."""
    return F.array_join(F.transform(conversation, lambda m: m["content"]), " ")


def n_words(conversation: Column) -> Column:
    """Words over all messages; null contents count nothing."""
    return F.coalesce(
        F.aggregate(conversation, F.lit(0), lambda acc, m: acc + TX.word_count(m["content"])),
        F.lit(0),
    )


def n_chars(conversation: Column) -> Column:
    """Characters over all messages; null contents count nothing."""
    return F.coalesce(
        F.aggregate(conversation, F.lit(0), lambda acc, m: acc + TX.char_count(m["content"])),
        F.lit(0),
    )


def n_chars_json(text: Column) -> Column:
    """Characters of a conversation stored as JSON; unreadable text counts its own length."""
    parsed = F.from_json(text, schemas.CONVERSATION)
    return F.when(parsed.isNull(), TX.char_count(text)).otherwise(n_chars(parsed))


def n_turns(conversation: Column) -> Column:
    return F.coalesce(F.size(conversation), F.lit(0))


def n_user_turns(conversation: Column) -> Column:
    """Number of messages of role user."""
    return F.coalesce(F.size(F.filter(conversation, lambda m: m["role"] == "user")), F.lit(0))


def user_turns(conversation: Column) -> Column:
    """Non-empty contents of messages sent by a user or human."""
    sent = F.filter(
        conversation,
        lambda m: F.lower(m["role"]).isin("user", "human") & (TX.char_count(m["content"]) > 0),
    )
    return F.transform(sent, lambda m: m["content"])


def first_turn(turns: Column) -> Column:
    return F.try_element_at(turns, F.lit(1))


def last_turn(turns: Column) -> Column:
    return F.try_element_at(turns, F.lit(-1))


def first_nonblank_turn(turns: Column) -> Column:
    """First turn with any text in it, trimmed; null if there is none."""
    return TX.strip(F.try_element_at(F.filter(turns, lambda t: ~TX.is_blank(t)), F.lit(1)))


def any_flagged(moderation: Column) -> Column:
    """True if any message carries the flag; empty or missing moderation is not flagged."""
    return F.coalesce(F.exists(moderation, lambda m: F.coalesce(m["flagged"], F.lit(False))), F.lit(False))


def flagged_categories(moderation: Column) -> Column:
    """Sorted distinct names of true categories over the flagged messages."""
    names = F.transform(
        F.filter(moderation, lambda m: m["flagged"]),
        lambda m: F.coalesce(F.map_keys(F.map_filter(m["categories"], lambda _, v: v)), F.array()),
    )
    return F.array_sort(F.array_distinct(F.flatten(names)))


def is_clean(moderation: Column) -> Column:
    """True if no category is true in any message, whatever the flag says."""
    return F.coalesce(
        ~F.exists(
            moderation,
            lambda m: F.coalesce(
                F.exists(F.map_values(m["categories"]), lambda v: F.coalesce(v, F.lit(False))), F.lit(False)
            ),
        ),
        F.lit(True),
    )


def categories_as_map(categories: Column) -> Column:
    """A struct of category flags, as Parquet stores it, as a map."""
    return F.from_json(F.to_json(categories), T.MapType(T.StringType(), T.BooleanType()))


def user_part(text: Column) -> Column:
    """Flattened text up to the first assistant marker."""
    return F.split_part(text, F.lit(K.ASSISTANT_MARK), F.lit(1))


def readable(text: Column) -> Column:
    """Flattened text with each marker as a line of its own."""
    marked = F.replace(text, F.lit(K.USER_MARK), F.lit("\nUSER:"))
    return F.replace(marked, F.lit(K.ASSISTANT_MARK), F.lit("\nASSISTANT:"))
