"""Helpers for functions over Arrow batches."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
SLICE_BYTES = 1 << 20


def slices(batches, size: int = SLICE_BYTES):
    """The batches cut to about ``size`` bytes (one row at least), so that a
    task's Python objects stay small whatever the batch size is."""
    for b in batches:
        rows = max(1, int(len(b) * size / max(1, b.nbytes)))
        for lo in range(0, len(b), rows):
            yield b.slice(lo, rows)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes in
    this session: whole texts are large rows, and a task holds a batch twice,
    in the executor and in its Python worker."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
