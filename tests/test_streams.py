import numpy as np
import pytest
from pyspark.sql import functions as F

from flowbench.streaming import streams

SCHEMA = "id int, v array<double>"


def batches(spark, n=4):
    rng = np.random.default_rng(3)
    return [spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(rng.normal(b, 1.0, (20, 2)))], SCHEMA) for b in range(n)]


def put(folder, *parts):
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(folder)


def plain(parts, centers, decay):
    c, w = centers.astype(float).copy(), np.zeros(len(centers))
    for p in parts:
        x = np.array([r["v"] for r in p.collect()])
        at = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        w *= decay
        for j in set(at):
            mine = x[at == j]
            w[j] += len(mine)
            c[j] += (mine.mean(0) - c[j]) * len(mine) / w[j]
    return c, w


def table(df):
    rows = df.orderBy("cluster").collect()
    return np.array([r["center"] for r in rows]), np.array([r["weight"] for r in rows])


FIRST = np.array([[0.0, 0.0], [3.0, 3.0], [50.0, 50.0]])


@pytest.mark.parametrize("decay", [1.0, 0.5])
def test_restart_goes_on_where_it_stopped(spark, tmp_path, decay):
    parts, folder, state = batches(spark), str(tmp_path / "in"), str(tmp_path / "state")
    put(folder, *parts[:2])
    stream = lambda: streams.stream_table(spark, folder, SCHEMA, per_trigger=1)
    got = table(streams.stream_kmeans(stream(), "v", FIRST, decay, state))
    assert all(np.allclose(a, b) for a, b in zip(got, plain(parts[:2], FIRST, decay)))
    put(folder, *parts[2:])
    again = table(streams.stream_kmeans(stream(), "v", FIRST + 9, decay, state))  # other first centres do not matter any more
    assert all(np.allclose(a, b) for a, b in zip(again, plain(parts, FIRST, decay)))
    nothing = table(streams.stream_kmeans(stream(), "v", FIRST, decay, state))
    assert all((a == b).all() for a, b in zip(nothing, again))


def test_a_batch_run_twice_is_learned_once(spark, tmp_path):
    parts = batches(spark)
    kept = streams.BatchTable(spark, str(tmp_path / "centers"), streams._CENTERS)
    kept.begin(spark.createDataFrame([(i, c.tolist(), 0.0) for i, c in enumerate(FIRST)], streams._CENTERS))
    for i in (0, 0, 1, 2, 2, 2, 3, 3):
        streams.learn_centers(kept, "v", 1.0, parts[i], i)
    got = table(kept.before())
    assert all(np.allclose(a, b) for a, b in zip(got, plain(parts, FIRST, 1.0))) and got[1].sum() == 80
    assert spark.read.parquet(str(tmp_path / "centers")).select("slot").distinct().count() == 3  # the first table and two slots


def test_a_failed_batch_is_learned_once(spark, tmp_path, monkeypatch):
    parts, folder, state = batches(spark), str(tmp_path / "in"), str(tmp_path / "state")
    put(folder, *parts)
    plain_learn, failed = streams.learn_centers, []

    def fail_after_writing(kept, vec, decay, batch, number):
        plain_learn(kept, vec, decay, batch, number)
        if number == 2 and not failed:
            failed.append(number)
            raise RuntimeError("lost before the batch was committed")

    monkeypatch.setattr(streams, "learn_centers", fail_after_writing)
    stream = lambda: streams.stream_table(spark, folder, SCHEMA, per_trigger=1)
    with pytest.raises(Exception, match="lost before"):
        streams.stream_kmeans(stream(), "v", FIRST, path=state)
    got = table(streams.stream_kmeans(stream(), "v", FIRST, path=state))
    assert failed and all(np.allclose(a, b) for a, b in zip(got, plain(parts, FIRST, 1.0)))


def test_counters_after_restart_and_without_input(spark, tmp_path):
    parts, folder, state = batches(spark, 3), str(tmp_path / "in"), str(tmp_path / "state")
    put(folder, parts[0].filter("id < 0"))
    count = lambda: tuple(streams.stream_counters(streams.stream_table(spark, folder, SCHEMA, per_trigger=1), F.col("id") < 5, F.col("id") >= 10, state).first())
    assert count() == (0, 0, 0)
    put(folder, *parts[:2])
    assert count() == (40, 10, 20)
    put(folder, parts[2])
    assert count() == (60, 15, 30) and count() == (60, 15, 30)
