"""Arrow batches that workers are handed."""

import pyarrow as pa
from pyspark.sql import functions as F

from waymark.llm.frames import BATCH_BYTES, PIECE, map_batches


def test_batches_are_small_not_only_their_pieces(spark):
    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def whole(piece):
        # A piece shares the buffers of the batch it was cut from.
        held = sum(b.size for b in piece.column("text").buffers() if b)
        return pa.RecordBatch.from_arrays([pa.array([held]), pa.array([piece.num_rows])], ["held", "n"])

    spark.conf.unset(BATCH_BYTES)
    found = map_batches(rows, whole, "held long, n long").collect()
    assert sum(r.n for r in found) == 4000
    assert max(r.held for r in found) < 2 * PIECE


def test_a_bound_of_the_session_is_kept(spark):
    try:
        spark.conf.set(BATCH_BYTES, "100k")
        map_batches(spark.range(3), lambda b: b, "id long").collect()
        assert spark.conf.get(BATCH_BYTES) == "100k"
    finally:
        spark.conf.unset(BATCH_BYTES)
