"""Corpus readers. Each declares its schema and keeps the file order as a column."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from convlens import constants as K
from convlens import session
from convlens.functions import conversation as C
from convlens.functions import columns as B

__all__ = ["read_parquet", "spread", "read_csv", "read_json_lines", "read_names", "read_embeddings", "read_split", "clean_dialogues", "filter_funnel", "preview", "with_row_ids", "scan_until", "finished", "chat_stages", "funnel"]


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, ordered: bool = False) -> DataFrame:
    """One or many Parquet files. With `ordered`, (file_name, row_index) gives the order of rows; the name is the full path."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    if not ordered:
        return df
    return df.select("*", F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.row_index").alias("row_index"))


def with_row_ids(spark: SparkSession, path: str | Sequence[str], name: str = "row_id", offset: int = 0) -> DataFrame:
    """One or many Parquet files with dense ids 0..n-1 in the order of (path, row).

    Rows are counted per file, which takes no column; the running count of the
    files before is added to each row's place in its own file. The table of
    counts has one row per file and is written first, so Spark knows its size:
    below the broadcast limit no row moves.
    """
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    sizes = df.groupBy(file.alias("_file")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = session.stage(sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    placed = df.select("*", file.alias("_file"), row.alias("_row")).join(starts, "_file")
    return placed.select(*df.columns, (F.col("_start") + F.col("_row") + F.lit(offset)).alias(name))


def scan_until(spark: SparkSession, path: str | Sequence[str], conditions: dict[str, Column], target: int, folder: str | None = None,
               first: int = 1) -> tuple[DataFrame, DataFrame]:
    """Read files in order until `target` rows meet all conditions: (those rows, one row of counts).

    `conditions` are cumulative, in order. Files are read by path, in batches of
    `first`, twice as many, and so on, and no file behind the last wanted row's
    batch is opened. Narrow passes over a batch find that row, if the batch holds
    it, and the counts; then what was kept is written.
    Counts are `scanned`, one per condition, and `kept`; rows behind the last one
    wanted are not in them.

    Every finished batch is written to `folder` with its counts; a scan that is
    started again with the same folder goes on behind them. Neither rows nor
    counts depend on partitioning.
    """
    folder = folder or f"{session.checkpoint_dir(spark)}/scan-{uuid.uuid4().hex}"
    source = spark.read.parquet(*([path] if isinstance(path, str) else path))
    files, schema = sorted(source.inputFiles()), source.schema
    flags, held = {}, F.lit(True)
    for label, condition in conditions.items():
        held = held & F.coalesce(condition, F.lit(False))
        flags[label] = held
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    names = ["scanned", *flags, "kept"]
    totals, parts, at, size, batch = dict.fromkeys(names, 0), [], 0, first, 0
    while at < len(files) and totals["kept"] < target:
        own = spark.read.schema(schema).parquet(*files[at : at + size])
        rows_at, counts_at = f"{folder}/rows-{batch}", f"{folder}/counts-{batch}"
        if not finished(spark, counts_at):
            marked = own.select("*", *place).withColumns({f"_c_{n}": c for n, c in flags.items()})
            missing = target - totals["kept"]
            wanted = marked.filter(held)
            # A bounded heap per task: the first places in order, at most the missing number.
            cut = wanted.select("_file", "_row").orderBy("_file", "_row").limit(missing).agg(
                F.count("*").alias("n"), F.max(F.struct("_file", "_row")).alias("last")
            ).first()
            inside = F.lit(True)
            if cut["n"] == missing:
                last = cut["last"]
                inside = (F.col("_file") < last["_file"]) | ((F.col("_file") == last["_file"]) & (F.col("_row") <= last["_row"]))
            counters = [F.count(F.lit(1)).alias("scanned"), *[F.count_if(f"_c_{n}").alias(n) for n in flags]]
            rows = [*source.columns, "_file", "_row"]
            # Not observed on the way: a session that has observed a plan can no longer serialise MLlib's functions.
            found = marked.filter(inside).agg(*counters).first().asDict()
            marked.filter(inside).filter(held).select(*rows).write.mode("overwrite").parquet(rows_at)
            row = [int(found[n] or 0) for n in ["scanned", *flags]]
            spark.createDataFrame([(*row, row[-1])], ", ".join(f"`{n}` bigint" for n in names)).coalesce(1).write.mode("overwrite").parquet(counts_at)
        for n, v in spark.read.parquet(counts_at).first().asDict().items():
            totals[n] += v
        parts.append(rows_at)
        at, size, batch = at + size, 2 * size, batch + 1
    report = spark.createDataFrame([tuple(totals[n] for n in names)], ", ".join(f"`{n}` bigint" for n in names))
    kept = spark.read.parquet(*parts).drop("_file", "_row") if parts else source.limit(0)
    return kept, report


def finished(spark: SparkSession, path: str) -> bool:
    """True if the path holds a finished write, on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table out to as many tasks as the session asks for, before work on their texts.

    A file of one row group is read by one task. A local session over small
    files sets `spark.convlens.textTasks`; where it is unset, as on a cluster
    with large files, no row moves, whatever the table's size.
    """
    tasks = df.sparkSession.conf.get("spark.convlens.textTasks", None)
    return df.repartition(int(tasks)) if tasks else df


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, columns: Sequence[str] | None = None,
             multi_line: bool = True) -> DataFrame:
    """CSV with a header; cells may hold quotes, and line breaks with `multi_line`, which reads a file in one task."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    df = (reader if schema is None else reader.schema(schema)).csv(path)
    return df.select(*columns) if columns else df


def read_json_lines(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """JSON lines; the stem of each file becomes the `task` column."""
    df = spark.read.schema(schema).json(list(path) if not isinstance(path, str) else path)
    return df.withColumn("task", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.jsonl?)?$", 1))


def read_names(spark: SparkSession, path: str, schema: StructType, since: int = K.FIRST_NAME_YEAR) -> DataFrame:
    """Name counts from a given year on."""
    return read_csv(spark, path, schema, multi_line=False).filter(F.col("Year") >= since)


def read_embeddings(spark: SparkSession, path: str, encoder: str | None = None) -> DataFrame:
    """Embedding table; one encoder reads only its own folder."""
    df = spark.read.parquet(path)
    return df if encoder is None else df.filter(F.col("encoder") == encoder)


def read_split(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """Features and labels of a split, joined one to one and tagged."""
    from convlens.operators import joins

    return joins.load_split(spark.read.parquet(f"{folder}/X_{split}"), spark.read.parquet(f"{folder}/Y_{split}"), split)


def _stages(min_turns: int, language: str):
    """The cumulative conditions of the benign filter, in order."""
    english = F.coalesce(F.col("language") == language, F.lit(False))
    long = english & (C.n_user_turns(F.col("conversation")) >= min_turns)
    clean = long & C.is_clean(F.col("openai_moderation")) & ~F.coalesce(F.col("redacted"), F.lit(False))
    return {"english": english, "long": long, "clean": clean}


def clean_dialogues(df: DataFrame, min_turns: int = 3, language: str = "English", target: int | None = None) -> DataFrame:
    """English, long enough, unflagged, unredacted conversations.

    With `target`, the scan's early stop: the first `target` of them by id, on any partitioning.
    """
    kept = df.filter(_stages(min_turns, language)["clean"]).select(
        "conversation_id", "model", "language", "turn",
        C.n_user_turns(F.col("conversation")).alias("n_user_turns"), "conversation",
    )
    return kept if target is None else kept.orderBy("conversation_id").limit(target)


def filter_funnel(df: DataFrame, min_turns: int = 3, language: str = "English", target: int | None = None) -> DataFrame:
    """One row: rows scanned and left after each condition, and rows kept."""
    stages = _stages(min_turns, language)
    counts = df.agg(F.count("*").alias("scanned"), *[F.count_if(c).alias(n) for n, c in stages.items()])
    return counts.withColumn("kept", B.clip(F.col("clean"), upper=target) if target is not None else F.col("clean"))


def chat_stages(min_turns: int = 3, language: str = "English") -> dict[str, Column]:
    """The cumulative conditions over facts of chats: language, n_user_turns, clean, redacted."""
    english = F.coalesce(F.col("language") == language, F.lit(False))
    long = english & (F.col("n_user_turns") >= min_turns)
    return {"english": english, "long": long, "clean": long & F.col("clean") & ~F.coalesce(F.col("redacted"), F.lit(False))}


def funnel(facts: DataFrame, stages: dict[str, Column], target: int | None = None) -> DataFrame:
    """One row: rows scanned, left after each condition, and kept."""
    counts = facts.agg(F.count("*").alias("scanned"), *[F.count_if(c).alias(n) for n, c in stages.items()])
    last = F.col(list(stages)[-1])
    return counts.withColumn("kept", B.clip(last, upper=target) if target is not None else last)


def preview(df: DataFrame, n: int = 3) -> tuple[DataFrame, list[tuple[str, str]]]:
    """The first rows, and the columns with their types."""
    return df.limit(n), df.dtypes
