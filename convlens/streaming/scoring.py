"""Batch scoring applied to a stream: every step is narrow, so no state is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from convlens.functions import conversation as C
from convlens.functions import text as TX
from convlens.operators import models


def score_stream(stream: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """Clean and score nested conversations as they arrive."""
    text = C.text_with_roles(F.col("conversation"))
    return models.score(model, stream.withColumn("conversation_proc", TX.clean_text(text)), threshold)


def run_available(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the scores of everything that has arrived, then stop."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
