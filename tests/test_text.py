import re

import pytest
from pyspark.sql import functions as F

from convlens import constants as K
from convlens.functions import text as TX

TEXTS = [
    "Hi <b>there</b> :-) =D ; ok!\n<p\nx>Élan",
    "naïve 你好 ２ ½",
    "__ROLE_USER__ a",
    "end.",
    "",
    "éle",
    "non breaking space\x1cand\x85more",
    "  spaced   out  ",
    ":) ;-( =P :-D",
]


def one(spark, text, expr):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(expr(F.col("t")).alias("x")).first().x


def python_clean(text):
    flat = re.sub("<[^>]*>", "", text.replace("\n", " "))
    faces = re.findall(r"[:;=]-?[)(DP]", flat)
    return re.sub(r"\W+", " ", flat.lower()) + " ".join(faces).replace("-", "")


@pytest.mark.parametrize("text", TEXTS)
def test_clean_text_as_python(spark, text):
    assert one(spark, text, TX.clean_text) == python_clean(text)


@pytest.mark.parametrize("text", TEXTS)
def test_words_split_as_python(spark, text):
    assert one(spark, text, TX.words) == text.split()
    assert one(spark, text, TX.word_count) == len(text.split())
    assert one(spark, text, TX.strip) == text.strip()
    assert one(spark, text, TX.is_blank) == (text.strip() == "")


def test_null_text(spark):
    assert one(spark, None, TX.word_count) == 0
    assert one(spark, None, TX.char_count) == 0
    assert one(spark, None, TX.is_blank) is True


def test_emoticons_follow_without_space(spark):
    assert one(spark, "fine :-)", TX.clean_text) == "fine :)"


def test_stop_words(spark):
    assert one(spark, "this is a plain test", TX.without_stop_words) == "plain test"
    assert len(K.ENGLISH_STOP) == len(set(K.ENGLISH_STOP)) == 179


def test_tokens_and_ngrams(spark):
    assert one(spark, "It's the bomb a b", TX.letter_tokens) == ["it's", "bomb"]
    assert one(spark, "Two new kittens' toys xy", TX.lower_tokens) == ["kittens'", "toys"]
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    assert [r.g for r in df.select(TX.ngrams(F.col("w"), 2).alias("g")).collect()] == [["a b", "b c"], [], []]
    assert [r.g for r in df.select(TX.ngrams(F.col("w"), 3).alias("g")).collect()] == [["a b c"], [], []]


def test_language(spark):
    assert one(spark, "你好 world", TX.guess_language) == "zh"
    assert one(spark, "hello", TX.guess_language) == "en"
    assert one(spark, "", TX.guess_language) == "unknown"


def test_truncation(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "w array<string>")
    row = df.select(TX.last_tokens(F.col("w"), 2), TX.last_tokens(F.col("w"), 9), TX.first_tokens(F.col("w"), 2)).first()
    assert list(row) == [["b", "c"], ["a", "b", "c"], ["a", "b"]]
