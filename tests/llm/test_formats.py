"""Chats, token counts and packed ids against brute force and round trips."""

import hashlib
import json
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from convlens.llm import chat, packing, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, "  ", "Hello, World!", "don't they're o'clock's", "<|endoftext|>, and <|startoftext|>x", "naïve É́ é, İstanbul ΣΑΣ ½ ２",
       "a,b;c --- ... wow!!!", "tab\there\x0bvt\x1cfs nbsp　wide", "你好，世界。 hi。", "x" * 3000, "word, " * 5000, "Á, e̸> ≮", "(paren) [b] {c} _d_ ~e~"]


# --- chats


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE]"]),
    st.lists(st.sampled_from([*chat.CONTROL, "\\", "[", "/INST]", "<", "s>", "x", " ", "\n", "é"]), max_size=8).map("".join)), max_size=6))
def test_template_round_trip(turns):
    text = "".join(chat.turn_text(r, t)[0] for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(text)] == turns
    for _, t, a, b in chat.parse(text):
        assert chat.unescape(text[a:b]) == t


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_formatted_and_read_back(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (2, 1, "assistant", None), (2, 0, None, "x"), (3, 0, "assistant", "long " * 50_000),
            (3, 1, "tool", "r"), (3, 2, "assistant", "\\[INST]"), (None, 0, "user", "no id"), (4, 0, "user", "b"), (4, 0, "user", "a")]
    rows += [(5, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS segment", "'x' AS loss")
    for limit in (1, 50, chat.SEGMENT_CHARS):
        texts = chat.formatted(chat.canonical(df, "conv_id"), "conv_id", limit)
        got = {r.conv_id: r for r in chat.read_back(texts, "conv_id").collect()}
        for conv in {r[0] for r in rows}:
            turns = [(r or "", t or "") for _, _, r, t in sorted(((x[0], x[1], x[2] or "", x[3] or "") for x in rows if x[0] == conv), key=lambda x: x[1:])]
            learnt = "".join(t for r, t in turns if r == "assistant")
            r = got[conv]
            assert (r.n_turns, r.turns_sha256, r.loss_chars) == (len(turns), digest(turns), len(learnt))
            assert r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
            assert r.formatted_chars == sum(len(chat.turn_text(*t)[0]) for t in turns)
    assert chat.read_back(chat.formatted(df.filter("false"), "conv_id"), "conv_id").count() == 0


def test_layouts_by_schema(spark):
    rows = lambda df: sorted((r.id, r.turn, r.role, r.text) for r in chat.canonical(df, "id").collect())
    want = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")]
    messages = "array<struct<role:string,content:string>>"
    assert rows(spark.createDataFrame([(1, [("user", "hi"), ("assistant", "yo")], 7)], f"id int, messages {messages}, extra int")) == want
    assert rows(spark.createDataFrame([(1, [("human", "hi"), ("gpt", "yo")]), (2, None), (3, [])], "id int, conversations array<struct<from:string,value:string>>")) == want
    assert rows(spark.createDataFrame([(1, "hi", None, "yo")], "id int, instruction string, input string, output string")) == want
    assert rows(spark.createDataFrame([(1, "hi", "yo")], "id int, prompt string, completion string")) == want
    with pytest.raises(ValueError):
        chat.canonical(spark.createDataFrame([(1, "hi")], "id int, something string"), "id")
    with pytest.raises(ValueError):
        chat.canonical(spark.createDataFrame([(1, "hi")], "id int, prompt string"), "id")


@pytest.mark.parametrize("extra", ["prompt", "response", "input", "system", "instruction", "output", "text", "messages", "context"])
def test_columns_of_other_layouts_do_not_matter(spark, extra):
    """The largest layout that is whole decides, in tables and in records."""
    rows = lambda df: sorted((r.turn, r.role, r.text) for r in chat.canonical(df, "id").collect())
    want = [(0, "user", "hi"), (1, "assistant", "yo")]
    if extra != "text":
        turns = spark.createDataFrame([(1, 0, "user", "hi", "x"), (1, 1, "assistant", "yo", None)], f"id int, turn int, role string, text string, {extra} string")
        assert rows(turns) == want
    if extra != "messages":
        listed = spark.createDataFrame([(1, [("user", "hi"), ("assistant", "yo")], "x")], f"id int, messages array<struct<role:string,content:string>>, {extra} string")
        assert rows(listed) == want
        record = {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}], extra: "x"}
        assert chat.record_turns(json.dumps(record)) == [t[1:] for t in want]


def test_layouts_of_json_records(spark):
    records = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}], "source": "a"},
        {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]},
        {"instruction": "hi", "input": "", "output": "yo"}, {"prompt": "hi", "response": "yo", "meta": {"k": [1]}},
        {"system": "be", "prompt": "hi", "response": None}, {"odd": 1}, [1],
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(7, None), (8, "{broken")]
    got = {}
    for r in chat.canonical_records(spark.createDataFrame(rows, "id int, record string"), "id", "record").collect():
        got.setdefault(r.id, []).append((r.turn, r.role, r.text))
    two = [(0, "user", "hi"), (1, "assistant", "yo")]
    assert [sorted(got[i], key=str) for i in range(4)] == [two] * 4
    assert sorted(got[4]) == [(0, "system", "be"), (1, "user", "hi"), (2, "assistant", "")]
    assert all(got[i] == [(None, None, None)] for i in (5, 6, 7, 8))


# --- token counts


def brute_count(scores, unknown, word):
    """Best score over every segmentation, then fewest tokens."""
    piece = token_counts.START + word
    best = [(0.0, 0)]
    for end in range(1, len(piece) + 1):
        size = len(piece[end - 1].encode())
        found = [(-(best[end - 1][0] + unknown * size), best[end - 1][1] + size)]
        found += [(-(best[s][0] + scores[piece[s:end]]), best[s][1] + 1) for s in range(end) if piece[s:end] in scores]
        score, n = min(found)
        best.append((-score, n))
    return best[-1][1]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text(alphabet="abcd", min_size=1, max_size=9), max_size=30))
def test_trie_counts(words):
    pieces = {"▁": -3.0, "▁a": -2.0, "a": -2.5, "b": -2.5, "c": -4.0, "ab": -3.0, "bc": -3.25, "abc": -5.0, "▁ab": -4.0, "cab": -2.0}
    model = token_counts.Unigram(pieces, -10.0)
    model.count(words)
    assert model.counts == {w: brute_count(pieces, -10.0, w) for w in words}


def test_counts_of_documents(spark):
    model = token_counts.ranked_unigram(PIECES)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "id int, text string").selectExpr("*", "'x' AS _counts", "1 AS n_words")
    got = {r.id: r for r in token_counts.with_counts(df.drop("_counts", "n_words"), PIECES).collect()}
    for i, t in enumerate(ODD):
        words = (t or "").split()
        assert got[i].n_words == len(words)
        assert got[i].n_tokens == sum(brute_count(model.scores, model.unknown, w) for w in words)
    assert token_counts.by_source(df.drop("_counts", "n_words").filter("false"), PIECES, ["id"]).count() == 0
    assert math.isclose(sum(math.exp(s) for s in model.scores.values()), 1)


# --- packed ids


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.data())
def test_pack_round_trip(width, data):
    ids = data.draw(st.lists(st.integers(0, (1 << width) - 1), max_size=70))
    packed = packing.pack(np.array(ids, np.uint32), width)
    assert len(packed) == (len(ids) * width + 7) // 8
    start = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - start))
    assert packing.unpack(packed, width, start, n).tolist() == ids[start : start + n]


def test_width():
    assert [packing.width_of(v) for v in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_pieces_encode_like_whole_texts(monkeypatch):
    """Odd texts; all plain characters; a memory that forgets; long texts in parts. All at once and each alone."""
    whole = Tokenizer.from_file(WORDS)
    plain = [chr(c) for c in range(0x180)]
    texts = [*ODD, "TÜRKİYE CUMHURİYETİ, Ankara", "GAZETESİ. yeni", "ſ's 'S 'LLama ''s 's's x'd'", "ŉ ª²½ \x85\xa0\x1c\xad"]
    texts += [t for c in plain for t in (c, f"a{c}b", f"{c}{c}. {c}'s", f"1{c}1")]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for memory, chars in ((300_000, 1 << 19), (10, 1 << 19), (300_000, 50)):
        monkeypatch.setattr(packing, "PIECE_MEMORY", memory)
        monkeypatch.setattr(packing, "CHARS", chars)
        own = packing.PieceEncoder(Tokenizer.from_file(WORDS))
        assert [ids.tolist() for ids in own.many(texts)] == want
        assert [own.many([t])[0].tolist() for t in texts[:40]] == want[:40]
        assert own.many([]) == []


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abZéİßſŉÿ'.,!<|>_-  \n\x1f\xa01½²你̸́s tremdv")), max_size=25))
def test_pieces_encode_like_whole_texts_at_random(text):
    own = packing.encoder_for(WORDS)
    assert isinstance(own, packing.PieceEncoder)
    assert own.many([text])[0].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_rules_encode_whole_texts():
    """A tokenizer of other rules is not taken apart."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = packing.encoder_for(path)
    assert type(own) is packing.WholeEncoder
    whole = Tokenizer.from_file(path)
    assert [ids.tolist() for ids in own.many(ODD)] == [whole.encode(t or "", add_special_tokens=False).ids for t in ODD]


@pytest.mark.parametrize("block", [1, 40, packing.BLOCK_IDS])
def test_files(spark, tmp_path, block):
    rows = [(10 - i if i != 3 else None, t) for i, t in enumerate(ODD)] + [(10, "again, again"), (10, "again, again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS part", "2 AS start")
    path = str(tmp_path / "ids")
    packing.write_blocks(df, path, WORDS, 2, block_ids=block)
    got = packing.read_documents(spark, path).collect()
    whole = Tokenizer.from_file(WORDS)
    ids = lambda t: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
    by_start = sorted(got, key=lambda r: r.start)
    at = 0
    order = [r.doc_id for r in by_start]
    assert order == sorted(order, key=lambda x: (x is not None, x))
    for r in by_start:
        assert r.start == at
        at += r.n_tokens
    want = sorted((str(i), len(ids(t)), zlib.crc32(ids(t).tobytes())) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    chosen = spark.createDataFrame([(9,), (6,)], "doc_id bigint")
    texts = dict((i, t) for i, t in rows)
    assert {r.doc_id: r.ids for r in packing.read_ids(spark, path, chosen).collect()} == {i: ids(texts[i]).tolist() for i in (9, 6)}


def test_no_documents(spark, tmp_path):
    path = str(tmp_path / "ids")
    packing.write_blocks(spark.createDataFrame([], "doc_id bigint, text string"), path, WORDS, 2)
    assert packing.read_documents(spark, path).count() == 0
