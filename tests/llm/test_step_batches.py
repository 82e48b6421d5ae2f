"""Steps of a chain hand whole texts to Python a few at a time."""

import pyarrow as pa
from pyspark.sql import functions as F

from sievemark.llm import scratch

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_long_texts_go_to_python_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    counted = scratch.step(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n long"))
    docs = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("x"), 2000).alias("text"))
    try:
        found = [r.n for r in counted(spark, docs, "").collect()]
        assert sum(found) == 3000 and max(found) * 2000 <= 1.1 * scratch.BATCH_BYTES
        spark.conf.set(KEY, "100000000")  # what the session sets itself stays
        assert [r.n for r in counted(spark, docs, "").collect()] == [3000]
    finally:
        spark.conf.unset(KEY)
