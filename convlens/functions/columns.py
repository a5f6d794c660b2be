"""Conditional columns: labels, error types, flags, clipping, display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from convlens import constants as K


def equals(column: Column, value) -> Column:
    """1 where the column has the value, 0 elsewhere and for null."""
    return F.coalesce(column == F.lit(value), F.lit(False)).cast("int")


def harm_of(prompt_label: Column, response_label: Column, value: str = "harmful") -> Column:
    """1 if either label has the value; a missing label is not harmful."""
    v = F.lit(value)
    return F.when(prompt_label.eqNullSafe(v) | response_label.eqNullSafe(v), 1).otherwise(0)


def predicted(prob: Column, threshold: float = K.THRESHOLD) -> Column:
    return (prob >= threshold).cast("int")


def correct(pred: Column, harm: Column) -> Column:
    return pred == harm


def error_type(harm: Column, pred: Column) -> Column:
    return (
        F.when((harm == 0) & (pred == 1), "false_positive")
        .when((harm == 1) & (pred == 0), "false_negative")
        .otherwise("correct")
    )


def as_boolean(column: Column) -> Column:
    """Boolean of 'true'/'1'/'false'/'0' in any case and spacing; anything else is false."""
    text = F.lower(F.trim(column.cast("string")))
    return F.coalesce(text.isin("true", "1"), F.lit(False))


def clip(column: Column, lower=None, upper=None) -> Column:
    if lower is not None:
        column = F.greatest(column, F.lit(lower))
    return column if upper is None else F.least(column, F.lit(upper))


def or_missing(column: Column, mark: str = "<NA>") -> Column:
    return F.coalesce(column.cast("string"), F.lit(mark))


def group_name(adversarial: Column) -> Column:
    return F.when(adversarial, "adversarial").otherwise("normal")


def metric_name(harm: Column, negative: str = "specificity") -> Column:
    return F.when(harm == 1, "recall").otherwise(negative)


def counted_label(name: Column, part: Column, whole: Column) -> Column:
    """Display label 'name  (part/whole)'."""
    return F.format_string("%s  (%d/%d)", name, part.cast("bigint"), whole.cast("bigint"))


def excerpt(text: Column, width: int) -> Column:
    """Fixed-width display excerpt."""
    return F.substring(text, 1, width)
