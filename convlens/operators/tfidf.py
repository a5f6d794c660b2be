"""TF-IDF as tables: one row per (document, term)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions import text as TX


def term_counts(df: DataFrame, id_col: str, tokens: Column, max_n: int = 2) -> DataFrame:
    """(id, term, tf) over 1- to max_n-grams.

    Rows meet by id as texts, and are listed and counted where they lie: no
    occurrence is shuffled.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = df.repartition(tasks, id_col).select(id_col, TX.held(tokens).alias("_t"))
    grams = F.concat(*[TX.ngrams(F.col("_t"), n) for n in range(1, max_n + 1)])
    terms = listed.select(id_col, F.explode(grams).alias("term"))
    return terms.groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def idf(counts: DataFrame, n_docs: Column, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """(term, df, idf) of the vocabulary: ln((1 + N) / (1 + df)) + 1."""
    terms = counts.groupBy("term").agg(F.count("*").alias("df"))
    kept = terms.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    return kept.withColumn("idf", F.ln((1 + n_docs) / (1 + F.col("df"))) + 1)


def tfidf(df: DataFrame, id_col: str, tokens: Column, max_n: int = 2, min_df: int = 1, max_df: float = 1.0,
          sublinear: bool = True) -> DataFrame:
    """(id, term, weight), L2-normalised per document.

    A frequent term meets its one vocabulary row; AQE splits the partition such
    a term fills. A document's terms then meet once, for their norm.
    """
    n_docs = df.agg(F.count("*")).scalar()
    counts = term_counts(df, id_col, tokens, max_n)
    tf = 1 + F.ln("tf") if sublinear else F.col("tf")
    weighted = counts.join(idf(counts, n_docs, min_df, max_df), "term").select(
        id_col, "term", (tf * F.col("idf")).alias("_w")
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return weighted.select(id_col, "term", (F.col("_w") / norm).alias("weight"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = sizes.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    return sizes.withColumn("weight", whole["rows"] / (whole["classes"] * F.col("n")))
