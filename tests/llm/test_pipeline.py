import os
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_exact_stage(spark):
    rows = [(2, "a b", "en", "s", 3, "k"), (1, "a  b", "en", "s", 3, None), (1, "a  b", "en", "s", 3, None), (None, "a b", None, None, None, None), (None, "c", None, None, None, None),
            (None, "c", None, None, None, None), (5, None, "en", "s", 0, None), (6, "", "en", "s", 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = stage("exact_dedup")(spark, df, "")
    assert out.columns == df.columns
    assert sorted([(r["doc_id"], r["text"]) for r in out.collect()], key=str) == sorted([(1, "a  b"), (None, "c"), (5, None)], key=str)


def test_near_stage(spark):
    rng = random.Random(0)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(300)]
    rows = [(3, " ".join(base), "en", "s", 1, ""), (9, " ".join(base[:-1] + ["z"]), "en", "s", 1, ""), (4, " ".join(words), "en", "s", 1, ""), (None, " ".join(base), "en", "s", 1, ""),
            (5, None, "en", "s", 0, ""), (6, "", "en", "s", 0, "")]
    out = stage("near_dedup")(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted([r["doc_id"] for r in out.collect()], key=str) == sorted([3, 4, 5, 6, None], key=str)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept, before = docs, docs.count()
    for name, fn in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.write_through(fn(spark, kept, FOLDER), name)
        assert kept.columns == docs.columns
        n = kept.count()
        assert 0 < n <= before
        before = n
    bad = spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 0 or toxic = 1").join(kept, "doc_id").count()
    assert bad <= 2  # of the rated ones, on which the model was fitted
    pieces = corpus_pipeline.run(spark, FOLDER).toPandas()
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in kept.collect()}
    assert pieces.groupby("doc_id").length.sum().to_dict() == want
    assert pieces.groupby("sequence_id").length.sum().max() <= 1024


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
