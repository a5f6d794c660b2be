"""Round trips of every source and sink, and the filter funnel."""

import json

import pytest
from pyspark.sql import functions as F

from convlens import schemas, session, sources
from convlens.functions import conversation as C
from convlens.sources import readers, writers


def test_parquet_keeps_file_order(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.range(10, 15).coalesce(1).write.parquet(str(tmp_path / "b"))
    df = sources.read_parquet(spark, [str(tmp_path / "a"), str(tmp_path / "b")], ordered=True)
    assert df.count() == 15
    first = df.filter("id < 10").orderBy("file_name", "row_index").collect()
    assert [r.row_index for r in first] == list(range(10))


def test_csv_with_quotes_breaks_and_nested_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"\nthere, you', [("user", "a")])], "id long, t string, c array<struct<role:string,content:string>>")
    sources.write_csv(df, str(tmp_path / "x"))
    back = sources.read_csv(spark, str(tmp_path / "x"), columns=["t", "c"])
    row = back.first()
    assert row.t == 'say "hi"\nthere, you' and json.loads(row.c) == [{"role": "user", "content": "a"}]
    assert back.select(C.n_chars(C.normalize(back, "c"))).first()[0] == 1


def test_json_lines_task_and_names(spark, tmp_path):
    (tmp_path / "datasets_en.jsonl").write_text(
        json.dumps({"id": "1", "history": [{"user": "u", "bot": "b"}]}) + "\n" + json.dumps({"id": "2", "history": []})
    )
    df = sources.read_json_lines(spark, str(tmp_path / "datasets_en.jsonl"), schemas.ATTACK_DIALOGUE)
    got = {r.id: (r.task, len(r.history)) for r in df.collect()}
    assert got == {"1": ("datasets_en", 1), "2": ("datasets_en", 0)}
    (tmp_path / "names.csv").write_text("Id,Name,Year,Gender,Count\n1,Ann,1920,F,5\n2,Bob,1926,M,6\n")
    assert [r.Name for r in sources.read_names(spark, str(tmp_path / "names.csv"), schemas.NAMES).collect()] == ["Bob"]


def test_embeddings_by_encoder(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1.0]), (1, "b", [2.0])], schemas.EMBEDDINGS)
    sources.write_embeddings(df, str(tmp_path / "e"))
    one = sources.read_embeddings(spark, str(tmp_path / "e"), "b")
    assert [r.embedding for r in one.collect()] == [[2.0]]
    assert "PartitionFilters: [isnotnull(encoder" in one._jdf.queryExecution().executedPlan().toString()


def stored(path):
    return sorted(p.name for p in path.iterdir() if p.name.startswith("data-"))


def test_materialize_computes_once(spark, tmp_path):
    path = tmp_path / "m"
    for _ in range(2):
        assert sources.materialize(spark, str(path), lambda: spark.range(3)).count() == 3
        assert len(stored(path)) == 1
    assert sources.materialize(spark, str(path), lambda: spark.range(4)).count() == 4  # another plan
    assert len(stored(path)) == 2


def test_a_changed_input_is_computed_anew(spark, tmp_path):
    source, path = str(tmp_path / "in"), tmp_path / "m"

    def build():
        return spark.read.parquet(source).filter("id > 1")

    spark.range(3).write.parquet(source)
    assert sources.materialize(spark, str(path), build).count() == 1
    spark.range(5).write.mode("append").parquet(source)
    assert sources.materialize(spark, str(path), build).count() == 4
    assert len(stored(path)) == 2


def test_a_broken_write_is_not_seen(spark, tmp_path, monkeypatch):
    path = tmp_path / "m"

    def fail(df, where):
        df.write.parquet(where)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(writers, "write_parquet", fail)
        with pytest.raises(RuntimeError):
            sources.materialize(spark, str(path), lambda: spark.range(3))
    assert not list(path.glob("manifest-*"))
    assert sources.materialize(spark, str(path), lambda: spark.range(3)).count() == 3


def test_two_builders_leave_one_result(spark, tmp_path, monkeypatch):
    path, write = tmp_path / "m", writers.write_parquet

    def slower(df, where):  # another builder finishes while this one writes
        monkeypatch.setattr(writers, "write_parquet", write)
        sources.materialize(spark, str(path), lambda: spark.range(3))
        write(df, where)

    monkeypatch.setattr(writers, "write_parquet", slower)
    assert sources.materialize(spark, str(path), lambda: spark.range(3)).count() == 3
    assert len(stored(path)) == 1 and len(list(path.glob("manifest-*"))) == 1 and not list(path.glob("draft-*"))


def test_row_ids_over_many_files(spark, tmp_path):
    """Ids follow (path, row), without moving rows; an empty file takes none."""
    for i, n in enumerate([5, 0, 7, 1]):
        spark.range(n).select((F.col("id") * 10 + i).alias("v"), F.lit("x").alias("row_index")).coalesce(1).write.parquet(str(tmp_path / f"f{i}"))
    df = sources.with_row_ids(spark, [str(tmp_path / f"f{i}") for i in (2, 0, 3, 1)], offset=10)
    assert df.columns == ["v", "row_index", "row_id"]
    rows = df.orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(10, 23))
    assert [r.v for r in rows] == [i * 10 for i in range(5)] + [i * 10 + 2 for i in range(7)] + [3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Sort" not in plan


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shards")
    for i in range(20):
        rows = [(100 * i + j, "en" if j % 2 else None, j) for j in range(100)]
        spark.createDataFrame(rows, "id long, lang string, size long").coalesce(1).write.option("parquet.block.size", 512).parquet(str(folder / f"s{i:02d}"))
    return [str(folder / f"s{i:02d}") for i in range(20)]


def conditions():
    return {"english": F.col("lang") == "en", "long": F.col("size") >= 50}


@pytest.mark.parametrize("target", [1, 5, 25, 26, 130, 10_000])
def test_scan_stops_early(spark, shards, tmp_path, target):
    """Each file keeps 25 of its 100 rows, in its second half; files behind the last wanted row are not opened."""
    folder = str(tmp_path / "scan")
    kept, report = sources.scan_until(spark, shards, conditions(), target, folder)
    order = [100 * i + j for i in range(20) for j in range(100) if j % 2 and j >= 50][:target]
    assert sorted(r.id for r in kept.collect()) == order and kept.columns == ["id", "lang", "size"]
    row, last = report.first(), order[-1] if len(order) == target else 1999
    assert (row.scanned, row.english, row.long, row.kept) == (last + 1, (last + 1) // 2, len(order), len(order))
    batches = len(list((tmp_path / "scan").glob("rows-*")))
    files = min(20, 2**batches - 1)
    assert files < 2 * (last // 100 + 1) + 1 or target == 10_000


def test_scan_goes_on_where_it_broke(spark, shards, tmp_path, monkeypatch):
    folder, done = str(tmp_path / "scan"), []
    whole = sources.scan_until(spark, shards, conditions(), 130)
    real = readers.finished

    def breaks(s, path):
        if path.endswith("counts-2") and not done:
            done.append(1)
            raise RuntimeError("lost")
        return real(s, path)

    monkeypatch.setattr(readers, "finished", breaks)
    with pytest.raises(RuntimeError):
        sources.scan_until(spark, shards, conditions(), 130, folder)
    first = (tmp_path / "scan" / "rows-0" / "_SUCCESS").stat().st_mtime_ns
    kept, report = sources.scan_until(spark, shards, conditions(), 130, folder)
    assert (tmp_path / "scan" / "rows-0" / "_SUCCESS").stat().st_mtime_ns == first
    assert report.first() == whole[1].first() and sorted(kept.collect()) == sorted(whole[0].collect())


def test_scan_of_nothing(spark, shards):
    kept, report = sources.scan_until(spark, shards[:2], {"none": F.lit(None).cast("boolean")}, 3)
    assert kept.count() == 0 and tuple(report.first()) == (200, 0, 0)


def test_stage_writes_to_the_named_folder(spark):
    staged = session.stage(spark.range(5))
    assert staged.count() == 5
    assert session.checkpoint_dir(spark) in staged.inputFiles()[0]


def test_split_files_round_trip(spark, tmp_path):
    rows = [(i, f"t{i}", f"p{i}", i % 2, s) for i, s in enumerate(["train", "train", "val", "test"])]
    df = spark.createDataFrame(rows, "conversation_id long, conversation string, conversation_proc string, harm int, split string")
    sources.write_splits(df, str(tmp_path / "s"))
    back = sources.read_split(spark, str(tmp_path / "s"), "train")
    assert sorted(r.conversation_id for r in back.collect()) == [0, 1] and back.first().split == "train"


def test_json_report_sample_and_preview(spark, tmp_path):
    sources.write_sample(spark.range(9), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    head, types = sources.preview(spark.range(9), 2)
    assert head.count() == 2 and types == [("id", "bigint")]


@pytest.fixture(scope="module")
def chats(spark):
    talk = [("user", "a"), ("assistant", "b")] * 3
    clean, bad = [(False, {"hate": False})], [(False, {"hate": True})]
    rows = [
        ("1", "m", talk, 3, "English", clean, False), ("2", "m", talk, 3, "English", bad, False),
        ("3", "m", talk, 3, "English", None, True), ("4", "m", talk[:2], 1, "English", [], False),
        ("5", "m", talk, 3, "French", [], False), ("6", "m", talk, 3, "English", [], None), ("7", "m", talk, 3, None, [], False),
    ]
    return spark.createDataFrame(rows, schemas.MULTI_TURN)


def test_funnel(chats):
    assert sources.filter_funnel(chats, target=1).first().asDict() == {"scanned": 7, "english": 5, "long": 4, "clean": 2, "kept": 1}
    assert sorted(r.conversation_id for r in sources.clean_dialogues(chats).collect()) == ["1", "6"]
    assert sources.clean_dialogues(chats, target=1).count() == 1
    assert chats.filter(F.col("language") == "English").count() == 5
