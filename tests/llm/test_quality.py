import random

import numpy as np
from pyspark.sql import functions as F

from flowbench.llm import quality


def test_gradient():
    rng = np.random.default_rng(0)
    lists = [np.sort(rng.choice(12, rng.integers(1, 6), replace=False)) for _ in range(30)]
    at, sizes = np.concatenate(lists), np.array([len(x) for x in lists])
    args = (at, np.cumsum(sizes) - sizes, np.repeat(np.arange(30), sizes), rng.integers(0, 4, 30), 3, 0.01)
    x = rng.normal(size=3 + 12) * 0.3
    value, grad = quality._loss(x, *args)
    for i in range(len(x)):
        step = np.zeros(len(x))
        step[i] = 1e-6
        assert abs((quality._loss(x + step, *args)[0] - quality._loss(x - step, *args)[0]) / 2e-6 - grad[i]) < 1e-5


def test_minimise_finds_the_bottom():
    a = np.diag([1.0, 10.0, 100.0])
    x = quality.minimise(lambda v: (0.5 * v @ a @ v - v.sum(), a @ v - 1), np.zeros(3), 100)
    assert np.allclose(x, [1, 0.1, 0.01], atol=1e-3)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    docs, ratings = [], []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2, 2])
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        if grade == 0:
            text[rng.randrange(len(text))] = rng.choice(["scum", "vile", "rotten"])
        if grade == 1:
            text = [w.upper() + "!!" for w in text]
        docs.append((i, " ".join(text), "x", 1.0))
        ratings.append((i, 0 if grade == 1 else 1, int(grade == 0)))
    return docs, ratings


DOCS, RATINGS = "doc_id long, text string, kept string, tail_prob double", "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs, ratings = corpus(1500, 1)
    df = spark.createDataFrame(docs, DOCS)
    rated = spark.createDataFrame(ratings[:1000] + [(5000, 1, 0), (None, 1, 0), (1200, None, None), (1201, 1, None)], RATINGS)
    grader = quality.fit_quality(df, rated, quality.grade_of(F.col("quality"), F.col("toxic")))
    assert (np.diff(grader.thresholds) > 0).all()
    out = {r["doc_id"]: r for r in quality.grade_documents(df, grader).collect()}
    assert set(quality.grade_documents(df, grader).columns) == {"doc_id", "text", "expected_grade", "tail_prob", "kept"}
    held = ratings[1000:]
    good = [out[i]["kept"] for i, q, t in held if q and not t]
    bad = [out[i]["kept"] for i, q, t in held if t or not q]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.05
    grades = [(0 if t else 1 + q, out[i]["expected_grade"]) for i, q, t in held]
    assert np.mean([e for g, e in grades if g == 0]) < np.mean([e for g, e in grades if g == 1]) < np.mean([e for g, e in grades if g == 2])


def test_sample_is_bounded_and_the_same_for_any_partitions(spark):
    docs, ratings = corpus(300, 2)
    rated = spark.createDataFrame(ratings, RATINGS)
    grade = quality.grade_of(F.col("quality"), F.col("toxic"))
    a = quality.fit_quality(spark.createDataFrame(docs, DOCS).repartition(3, "doc_id").sortWithinPartitions("doc_id"), rated, grade, sample_rows=50)
    b = quality.fit_quality(spark.createDataFrame(docs, DOCS).repartition(9, "doc_id").sortWithinPartitions("doc_id"), rated, grade, sample_rows=50)
    assert np.allclose(a.thresholds, b.thresholds, atol=1e-3)
    few = quality.fit_quality(spark.createDataFrame(docs, DOCS), rated, grade, sample_rows=1)
    assert len(few.thresholds) >= 1


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "", 0.0), (2, "", "", 0.0), (None, "a", "", 0.0), (2, "", "", 0.0), (3, "long " * 200_000, "", 0.0)], DOCS)
    grade = quality.grade_of(F.col("quality"), F.col("toxic"))
    none = quality.fit_quality(df, spark.createDataFrame([], RATINGS), grade)
    out = quality.grade_documents(df, none).collect()
    assert len(out) == 5 and all(r["kept"] and r["tail_prob"] > 0.999 for r in out)
    some = quality.fit_quality(df, spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, 1, 1)], RATINGS), grade)
    assert len(quality.grade_documents(df, some).collect()) == 5
    assert quality.grade_documents(df.limit(0), some).collect() == []
