"""What tasks hold at once: small blocks in language identification, and Arrow batches to Python bounded by bytes."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rentmill.llm import language_id, packing
from rentmill.llm.blocks import text_blocks
from rentmill.llm.tables import ARROW_BYTES, small_batches, tidy


def test_a_block_of_language_identification_is_small():
    batch = pa.RecordBatch.from_pydict({"text": [f"some words of text {k} " * 100 for k in range(2000)]})
    weights, peaks = np.ones(language_id.DIMENSIONS, np.float32), []
    tracemalloc.start()
    for block in text_blocks([batch], most_bytes=language_id.BLOCK_BYTES, most_rows=language_id.BLOCK_ROWS):
        language_id._vectors(language_id.gram_counts(block.column("text")), weights)
        peaks.append(tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert sum(block.num_rows for block in text_blocks([batch], most_rows=language_id.BLOCK_ROWS)) == 2000
    assert max(peaks) < 24 << 20


def test_arrow_batches_are_bounded_by_bytes(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', 1000)").alias("text")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    for bounded in (small_batches(docs), tidy(docs)):
        got = bounded.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in got) == 3000 and max(r.bytes for r in got) < 2 << 20


def test_stages_of_whole_texts_use_small_batches(spark, documents):
    before, docs = spark.conf.get(ARROW_BYTES), documents([(k, f"the and of with that {k}") for k in range(20)])
    kept = language_id.keep_accepted(docs, language_id.fit(docs))
    assert kept.sparkSession.conf.get(ARROW_BYTES) == "1m" and kept.count() == 20
    assert packing.pack(docs).sparkSession is docs.sparkSession and spark.conf.get(ARROW_BYTES) == before
