"""The pipeline's stages in order on planted documents, and the guard around the subpackage."""

import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

ROOT = Path(corpus_pipeline.__file__).parent


def text(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng, folder = random.Random(11), tmp_path_factory.mktemp("tables")
    rows = [(i, text(rng, 60), "en", "a" if i % 3 else "b") for i in range(200)]
    item = text(rng, 30)
    rows += [(1000 + i, rows[i][1], "en", "a") for i in range(10)]  # copies
    rows += [(2000 + i, f"{text(rng, 20)} {item.upper()} {text(rng, 20)}", "en", "a") for i in range(5)]
    rows += [(3000 + i, f"{text(rng, 30)} vile {text(rng, 30)}", "en", "a") for i in range(60)]
    rows += [(4000, None, None, None), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({"n_chars": F.length("text").cast("bigint"), "rejected": F.lit("mine"), "copies": F.lit(7), "hits": F.lit(1)})
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(100)] + [(3000 + i, 1, 1) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_stages(spark, planted, tmp_path):
    folder, rows = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.filter("rejected <> 'mine' OR copies <> 7").count() == 0
        kept[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    clean = {i for i, *_ in rows if i < 1000 or i == 4000}
    assert {i for i in kept["toxicity"] if i < 3000 or i == 4000} == {i for i, *_ in rows if i < 3000 or i == 4000}
    assert not [i for i in kept["toxicity"] if 3000 <= i < 4000]
    assert kept["near_dedup"] == sorted(clean | {2000 + i for i in range(5)})
    assert kept["decontamination"] == sorted(clean)
    assert set(kept["mixing"]) == clean and len(kept["mixing"]) > len(clean)
    assert kept["token_ids"] == kept["mixing"]
    whole, texts = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {r[0]: r[1] for r in rows}
    at = 0
    for r in sorted(docs.collect(), key=lambda r: r.start):
        ids = np.array([*whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == kept["token_ids"]


def test_stages_on_no_documents(spark, planted):
    folder, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_the_rest_stands_without_the_subpackage():
    hide = (
        "import sys, importlib.abc\n"
        "class Hide(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('convlens.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", hide], cwd=ROOT, check=True)
