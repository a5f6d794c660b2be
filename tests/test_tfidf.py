"""Term counts move texts, not occurrences."""

from pyspark.sql import functions as F

from convlens.functions import text as TX
from convlens.operators import tfidf


def test_counts_shuffle_texts_only(spark):
    rows = spark.createDataFrame([(1, "aa bb aa"), (1, "bb cc"), (None, "aa"), (2, None)], "id long, text string")
    out = tfidf.term_counts(rows, "id", TX.term_tokens(F.col("text")), 1)
    assert sorted((r.id or 0, r.term, r.tf) for r in out.collect()) == [(0, "aa", 1), (1, "aa", 2), (1, "bb", 2), (1, "cc", 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    found = [line for line in plan.splitlines() if "Exchange" in line]
    final = found[: len(found) // 2] if "Initial Plan" in plan else found
    assert final and not any("term" in line for line in found)
