"""What a Python worker holds at a time follows from a slice of rows, not from the batches that Spark sends."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from flowbench.llm import common, near_dedup, quality

ROWS = 3 * common.SLICE_ROWS + 1


class Taken:
    """Stands for a table; gives back the function that its rows go through."""

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def select(self, *cols):
        return self

    def mapInArrow(self, run, schema):
        return run


def _batch() -> pa.RecordBatch:
    texts = [None if i % 97 == 0 else f"word{i % 7} and other{i} words stand in this text number {i}" for i in range(ROWS)]
    return pa.RecordBatch.from_arrays([pa.array(range(ROWS), pa.int64()), pa.array(texts)], names=["doc_id", "text"])


def _runs():
    grader = quality.Grader(np.linspace(-1, 1, 1 << quality.BITS).astype(np.float32), np.array([-0.5, 0.5]))
    return {"near": near_dedup.signed(Taken(), 5, 32, 4), "quality": quality.grade_documents(Taken(), grader)}


@pytest.mark.parametrize("name", ["near", "quality"])
def test_work_goes_by_slices_and_loses_nothing(name):
    run, batch = _runs()[name], _batch()
    out = list(run(iter([batch])))
    assert max(b.num_rows for b in out) <= common.SLICE_ROWS
    alone = [b for i in range(ROWS) for b in run(iter([batch.slice(i, 1)]))]
    assert pa.Table.from_batches(out).to_pylist() == pa.Table.from_batches(alone).to_pylist()


def test_slices_keep_order_and_leave_out_empty_batches():
    batch = _batch()
    parts = list(common.sliced([batch.slice(0, 0), batch, batch.slice(0, 1)], 400))
    assert max(p.num_rows for p in parts) <= 400 and min(p.num_rows for p in parts) > 0
    assert pa.Table.from_batches(parts).to_pylist() == pa.Table.from_batches([batch, batch.slice(0, 1)]).to_pylist()
