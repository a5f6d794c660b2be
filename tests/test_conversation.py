import json

from pyspark.sql import functions as F

from convlens import schemas
from convlens.functions import columns as B
from convlens.functions import conversation as C
from convlens.operators import names

TURNS = [("user", "Hi [NAME_1], meet [NAME_12]"), ("assistant", None), ("user", "  "), ("human", "bye [NAME_1]")]


def nested(spark, turns=TURNS):
    return spark.createDataFrame([(1, turns)], "id long, c array<struct<role:string,content:string>>")


def test_build_and_flatten(spark):
    df = spark.createDataFrame([("p q", None)], "p string, r string").select(C.from_prompt(F.col("p"), F.col("r")).alias("c"))
    row = df.select(C.text_with_roles(F.col("c")), C.n_words(F.col("c")), C.text_without_roles(F.col("c"))).first()
    assert list(row) == ["__ROLE_USER__ p q __ROLE_ASSISTANT__ ", 2, "p q "]


def test_lengths_ignore_null_content(spark):
    row = nested(spark).select(C.n_words(F.col("c")), C.n_chars(F.col("c")), C.n_turns(F.col("c")), C.n_user_turns(F.col("c"))).first()
    assert list(row) == [6, 27 + 2 + 12, 4, 2]


def test_user_turns(spark):
    u = C.user_turns(F.col("c"))
    row = nested(spark).select(F.size(u), C.first_turn(u), C.last_turn(u), C.first_nonblank_turn(u)).first()
    assert list(row) == [3, TURNS[0][1], TURNS[3][1], TURNS[0][1]]
    empty = nested(spark, []).select(C.first_turn(u), C.first_nonblank_turn(u)).first()
    assert list(empty) == [None, None]


def test_normalize_every_schema(spark):
    want = [("user", "u1"), ("assistant", "b1")]
    pairs = spark.createDataFrame([([("u1", "b1")],)], "h array<struct<user:string,bot:string>>")
    named = spark.createDataFrame([(want,)], "h array<struct<from:string,value:string>>")
    stored = spark.createDataFrame(
        [(json.dumps([{"role": r, "content": c} for r, c in want]),), (json.dumps([{"user": "u1", "bot": "b1"}]),)], "h string"
    )
    for df in (pairs, named, stored):
        for row in df.select(C.normalize(df, "h").alias("c")).collect():
            assert [tuple(m) for m in row.c] == want
    broken = spark.createDataFrame([("not json",)], "h string")
    assert broken.select(C.normalize(broken, "h").alias("c")).first().c is None


def test_json_length_falls_back_to_text(spark):
    df = spark.createDataFrame([('[{"role":"user","content":"abc"}]',), ("plain",)], "t string")
    assert [r.n for r in df.select(C.n_chars_json(F.col("t")).alias("n")).collect()] == [3, 5]


def test_moderation(spark):
    rows = [
        (1, [(True, {"hate": True, "sex": False}), (False, {"violence": True})]),
        (2, [(False, {"hate": True})]),
        (3, []),
        (4, None),
        (5, [(True, {"b": True, "a": True}), (True, {"a": True})]),
    ]
    df = spark.createDataFrame(rows, f"id int, m {schemas.MODERATION.simpleString()}")
    m = F.col("m")
    got = {r[0]: list(r)[1:] for r in df.select("id", C.any_flagged(m), C.flagged_categories(m), C.is_clean(m)).collect()}
    assert got == {
        1: [True, ["hate"], False], 2: [False, [], False], 3: [False, [], True], 4: [False, None, True], 5: [True, ["a", "b"], False],
    }


def test_categories_struct_to_map(spark):
    df = spark.createDataFrame([((True, False),)], "c struct<hate:boolean,sex:boolean>")
    assert df.select(C.categories_as_map(F.col("c")).alias("m")).first().m == {"hate": True, "sex": False}


def test_replace_names(spark):
    dictionary = spark.createDataFrame([(1, "Ann", 1), (2, "Bob", 3), (3, "Ann", 2)], "Id long, Name string, Count long")
    lo_hi = {r.name: (r.lo, r.hi) for r in names.name_intervals(dictionary).collect()}
    assert abs((lo_hi["Ann"][1] - lo_hi["Ann"][0]) - 0.4) < 1e-12
    df = nested(spark).withColumn("redacted", F.lit(True)).unionByName(
        nested(spark).withColumn("redacted", F.lit(False)).withColumn("id", F.lit(2).cast("long"))
    )
    out = {r.id: r.c for r in names.replace_in_conversations(df, "id", "c", dictionary, F.col("redacted")).collect()}
    assert out[2][0].content == TURNS[0][1]
    first, last = out[1][0].content, out[1][3].content
    assert "NAME" not in first + last and "[" in first
    assert last[5:8] == first[4:7]
    assert out[1][1].content is None


def test_names_follow_weights(spark):
    dictionary = spark.createDataFrame([(1, "Ann", 1), (2, "Bob", 3)], "Id long, Name string, Count long")
    tokens = spark.range(4000).select(F.col("id").alias("k"), F.lit("NAME_1").alias("token"))
    table = names.NameTable(names.name_intervals(dictionary))
    drawn = tokens.select("k", table.draw(F.col("k"), F.col("token")).alias("name"))
    assert "Exchange" not in drawn._jdf.queryExecution().executedPlan().toString()
    counts = {r["name"]: r["count"] for r in drawn.groupBy("name").count().collect()}
    assert sum(counts.values()) == 4000
    assert (counts["Ann"] - 1000) ** 2 / 1000 + (counts["Bob"] - 3000) ** 2 / 3000 < 10.8  # chi-square, one degree, 0.1 %
    assert names.NameTable(names.name_intervals(dictionary.limit(0))).starts == []


def test_labels_and_flags(spark):
    rows = [("harmful", None), (None, "harmful"), (None, None), ("unharmful", "unharmful")]
    df = spark.createDataFrame(rows, "p string, r string")
    assert [r.h for r in df.select(B.harm_of(F.col("p"), F.col("r")).alias("h")).collect()] == [1, 1, 0, 0]
    flags = spark.createDataFrame([(" True ",), ("1",), ("0",), ("yes",), (None,)], "f string")
    assert [r.b for r in flags.select(B.as_boolean(F.col("f")).alias("b")).collect()] == [True, True, False, False, False]


def test_role_marks(spark):
    df = spark.createDataFrame([("__ROLE_USER__ a __ROLE_ASSISTANT__ b",)], "t string")
    row = df.select(C.user_part(F.col("t")), C.readable(F.col("t"))).first()
    assert list(row) == ["__ROLE_USER__ a ", "\nUSER: a \nASSISTANT: b"]
    assert C.conversation_column(spark.createDataFrame([("x",)], "history string")) == "history"
