"""Data-quality checks. `violations` is lazy; `require` runs it and raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens import session
from convlens.functions import text as TX


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: for each rule the number of rows that break it, in one pass."""
    return df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in rules.items()])


def require(df: DataFrame, rules: dict[str, Column]) -> None:
    broken = {k: v for k, v in violations(df, rules).first().asDict().items() if v}
    if broken:
        raise ValueError(f"rows break rules: {broken}")


def require_unique(df: DataFrame, key: str) -> None:
    repeated = df.groupBy(key).count().filter("count > 1").limit(1).count()
    if repeated:
        raise ValueError(f"{key} is not unique")


def text_rules(text: str, label: str) -> dict[str, Column]:
    """Rules for a labelled text table: no null, no blank text, label 0 or 1."""
    return {
        "null_text": F.col(text).isNull(),
        "blank_text": F.col(text).isNotNull() & TX.is_blank(F.col(text)),
        "bad_label": ~F.coalesce(F.col(label).isin(0, 1), F.lit(False)),
    }


def embedding_rules(embedding: str, dimension: int) -> dict[str, Column]:
    """Rules for an embedding column: present, of one size, all values finite."""
    e = F.col(embedding)
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return {
        "missing": e.isNull(),
        "wrong_size": e.isNotNull() & (F.size(e) != dimension),
        "not_finite": bad,
    }


def unmatched(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of the left table without a partner on the right."""
    return left.join(right.select(F.col(right_key).alias(left_key)), left_key, "left_anti")


def split_summary(df: DataFrame, split: str = "split", label: str = "harm") -> DataFrame:
    """Size and share of positives of each split."""
    return df.groupBy(split).agg(F.count("*").alias("n"), F.avg(label).alias("harm_rate"))


def same_distribution(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Values whose counts differ between two builds of a table."""
    from convlens.operators.profile import aligned_counts

    return aligned_counts(a, b, column).filter("n_a <> n_b")


# --- two builds of a table, row by row ---------------------------------------

#: Hex digits of a key's digest that name a leaf, and digits that one level of the tree adds.
LEAF_DIGITS, STEP = 4, 1


def leaf_sums(df: DataFrame, key: str) -> DataFrame:
    """(leaf, n, a, b): rows, and two order-free sums of row digests, of each range of the key's digest.

    A leaf's sums do not depend on the order of rows or columns' places in files;
    repeated rows count each. At most 16 ** LEAF_DIGITS rows, combined before the shuffle.
    """
    names = sorted(df.columns)
    row = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    hashed = df.select(F.substring(_key_digest(key), 1, LEAF_DIGITS).alias("leaf"), F.sha2(row, 256).alias("_d"))
    halves = [F.conv(F.substring("_d", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(2)]
    return hashed.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(halves[0]).alias("a"), F.sum(halves[1]).alias("b"))


def _key_digest(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))


def level(leaves: DataFrame, digits: int) -> DataFrame:
    """Sums of all branches at a depth of the tree; depth 0 is the whole table in one row."""
    branch = F.substring("leaf", 1, digits) if digits else F.lit("")
    return leaves.groupBy(branch.alias("branch")).agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def differing_branches(left: DataFrame, right: DataFrame, digits: int, inside: list[str] | None = None) -> list[str]:
    """Branches of a depth whose sums differ, below the given branches of the depth above."""
    sides = []
    for side in (left, right):
        if inside is not None:
            side = side.filter(F.substring("leaf", 1, digits - STEP).isin(inside))
        sides.append(level(side, digits))
    same = F.col("l.n").eqNullSafe(F.col("r.n")) & F.col("l.a").eqNullSafe(F.col("r.a")) & F.col("l.b").eqNullSafe(F.col("r.b"))
    met = sides[0].alias("l").join(sides[1].alias("r"), F.col("l.branch") == F.col("r.branch"), "full_outer").filter(~same)
    return sorted(r[0] for r in met.select(F.coalesce("l.branch", "r.branch")).collect())


def table_difference(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(key, status) of every row that two builds of a table do not share, and how many branches were compared.

    Status is `left`, `right` or `changed`: the key's rows are only here, only
    there, or differ. Equal tables are found equal by one row; otherwise
    differing branches are descended, level by level, and only rows of differing
    leaves meet. Columns must have the same names; keys may repeat or be null.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("the tables have different columns")
    right = right.select(*left.columns)
    leaves = [session.stage(leaf_sums(side, key)) for side in (left, right)]
    branches, compared = differing_branches(*leaves, 0), 1
    for digits in range(STEP, LEAF_DIGITS + 1, STEP):
        if not branches:
            break
        compared += len(branches) * 16**STEP
        branches = differing_branches(*leaves, digits, branches)
    leaf = F.substring(_key_digest(key), 1, LEAF_DIGITS)
    inside = leaf.isin(branches) if branches else F.lit(False)
    row = F.sha2(F.to_json(F.struct(*sorted(left.columns)), {"ignoreNullFields": "false"}), 256)
    sides = [
        side.filter(inside).select(F.col(key).alias("key"), row.alias("d")).groupBy("key").agg(
            F.count("*").alias("n"), F.sum(F.conv(F.substring("d", 1, 15), 16, 10).cast("decimal(38,0)")).alias("s"))
        for side in (left, right)
    ]
    met = sides[0].alias("l").join(sides[1].alias("r"), F.col("l.key").eqNullSafe(F.col("r.key")), "full_outer")
    status = F.when(F.col("r.n").isNull(), "left").when(F.col("l.n").isNull(), "right").when(
        (F.col("l.n") != F.col("r.n")) | (F.col("l.s") != F.col("r.s")), "changed")
    found = met.select(F.coalesce("l.key", "r.key").alias(key), status.alias("status")).filter(F.col("status").isNotNull())
    return found, compared
