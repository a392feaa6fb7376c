"""Findings of round three: rows of the shingle join for each bucket, and batches of long documents."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyspark
import pytest

import __spark_entry__
from pacewise.llm import shingle_join
from pacewise.llm.common import BATCH_ROWS


def _dealt(monkeypatch, bits: int) -> pa.Table:
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 50, 120).tolist())) for _ in range(1_000)]
    texts[::3] = texts[:1] * len(texts[::3])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    return pa.Table.from_batches(list(shingle_join._dealer(5, bits)([batch])))


def test_slices_deal_no_more_bytes_to_more_buckets(monkeypatch):
    """each row held a count for every document of its slice, so that the bytes grew with the number of buckets."""
    few, many = _dealt(monkeypatch, 8), _dealt(monkeypatch, 11)
    assert many.num_rows == 8 * few.num_rows
    assert many.nbytes < 1.25 * few.nbytes


@pytest.mark.parametrize("bits", [8, 11])
def test_buckets_return_what_occurs_in_several_documents(monkeypatch, bits):
    dealt = _dealt(monkeypatch, bits)
    kept = pa.concat_tables([shingle_join._repeated(dealt.slice(at, 1)) for at in range(dealt.num_rows)])
    sets = shingle_join._assembler(bits, 75)(kept).to_pylist()
    alike = [row for row in sets if row["doc_id"] % 3 == 0]
    assert len(sets) == 1_000 and len({(row["first_sum"], row["second_sum"]) for row in alike}) == 1
    assert all(row["unique"] == 0 and len(row["tokens"]) == row["size"] == row["n_shingles"] for row in alike)
    assert all(row["tokens"] is None for row in sets if row["doc_id"] % 3)


@pytest.mark.parametrize("name", ["op1_jaccard_join", "jaccard_link_counts", "op10_packing"])
def test_queries_over_long_documents_take_small_batches(spark, monkeypatch, name):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(key)
    for module, function in (("shingle_join", "classes"), ("shingle_join", "link_counts"), ("packing", "packed"), ("packing", "piece_digests")):
        monkeypatch.setattr(f"pacewise.llm.{module}.{function}", lambda *a, **b: None)
    try:
        __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(key)) == BATCH_ROWS
    finally:
        spark.conf.unset(key)
