"""Text expressions: cleaning, counting, tokens, n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from convlens import constants as K


def held(column: Column) -> Column:
    """The column as a one-row generator, for costly text that a filter reads next.

    A filter moved below a projection makes the expression run twice; it does
    not move below a generator. Select it under an alias.
    """
    return F.explode(F.array(column))


def words(text: Column) -> Column:
    """The words of a text, split on Unicode white space."""
    return F.regexp_extract_all(text, F.lit(K.WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null and for blank text."""
    return F.coalesce(F.regexp_count(text, F.lit(K.WORD)), F.lit(0))


def char_count(text: Column) -> Column:
    """Number of code points; 0 for null."""
    return F.coalesce(F.length(text), F.lit(0))


def strip(text: Column) -> Column:
    """Text without leading and trailing white space."""
    return F.regexp_replace(text, K.OUTER_SPACE, "")


def is_blank(text: Column) -> Column:
    """True for null text and for text of white space only."""
    return F.coalesce(~text.rlike(K.NOT_BLANK), F.lit(True))


def clean_text(text: Column) -> Column:
    """Lower-cased words without tags and punctuation, then the emoticons.

    The emoticons follow without a separating space and lose their nose.
    """
    flat = F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(" ")), K.TAG, "")
    faces = F.regexp_extract_all(flat, F.lit(K.EMOTICON), F.lit(0))
    return F.concat(
        F.regexp_replace(F.lower(flat), K.NON_WORD, " "),
        F.replace(F.array_join(faces, " "), F.lit("-"), F.lit("")),
    )


def without_stop_words(text: Column, stop: Sequence[str] = K.ENGLISH_STOP) -> Column:
    """The words of a text that are not in the stop list, one space apart."""
    stop = list(stop)
    return F.array_join(F.filter(words(text), lambda w: ~w.isin(stop)), " ")


def letter_tokens(text: Column, stop: Sequence[str] = K.LETTERS_STOP) -> Column:
    """Runs of two or more letters or apostrophes that are not stop words."""
    stop = list(stop)
    found = F.regexp_extract_all(F.lower(text), F.lit(K.LETTERS_TOKEN), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(stop))


def lower_tokens(text: Column, stop: Sequence[str] = K.LOWER_STOP) -> Column:
    """Words starting with a letter, longer than two, that are not stop words."""
    stop = list(stop)
    found = F.regexp_extract_all(F.lower(text), F.lit(K.LOWER_TOKEN), F.lit(0))
    return F.filter(found, lambda w: (F.length(w) > 2) & ~w.isin(stop))


def term_tokens(text: Column, stop: Sequence[str] = ()) -> Column:
    """Lower-cased terms of two or more word characters, for TF-IDF."""
    found = F.regexp_extract_all(F.lower(text), F.lit(K.TERM_TOKEN), F.lit(0))
    stop = list(stop)
    return F.filter(found, lambda w: ~w.isin(stop)) if stop else found


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams of a token array (pass a named column, not an expression)."""
    if n == 1:
        return tokens
    grams = F.transform(
        tokens, lambda t, i: F.concat_ws(" ", t, *[F.get(tokens, i + k) for k in range(1, n)])
    )
    return F.slice(grams, F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))


def guess_language(text: Column) -> Column:
    """'zh' above 5 % CJK characters, 'unknown' for empty text, else 'en'."""
    share = F.regexp_count(text, F.lit(K.CJK)) / F.greatest(F.length(text), F.lit(1))
    return (
        F.when(char_count(text) == 0, "unknown").when(share > K.CJK_SHARE, "zh").otherwise("en")
    )


def normalized(text: Column) -> Column:
    """Lower-cased text with collapsed white space: the key of exact deduplication."""
    return F.lower(F.trim(F.regexp_replace(text, K.WHITE_SPACE, " ")))


def fingerprint(*columns: Column) -> Column:
    """256-bit digest that stands for the columns in grouping and joins.

    One column keeps its null; several columns are digested as JSON with their
    nulls, so nested columns can take part.
    """
    if len(columns) == 1:
        return F.sha2(columns[0].cast("string"), 256)
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def first_tokens(tokens: Column, n: int) -> Column:
    """Keep the first n tokens."""
    return F.slice(tokens, 1, n)


def last_tokens(tokens: Column, n: int) -> Column:
    """Keep the last n tokens (left truncation)."""
    return F.slice(tokens, F.greatest(F.size(tokens) - (n - 1), F.lit(1)), F.lit(n))


def with_task_prefix(text: Column, task: str = "classification") -> Column:
    """Text led by the task name an encoder expects."""
    return F.concat(F.lit(f"{task}: "), text)
