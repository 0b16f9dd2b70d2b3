"""Kernels get batches of bounded bytes, not 10,000 rows of whatever length."""

import pyarrow as pa

from strandforge.session import tune


def test_batches_of_long_texts_are_small(spark):
    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    tune(spark)
    docs = spark.range(600, numPartitions=1).selectExpr("repeat('0123456789abcdef', 4096) AS text")
    told = docs.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
    assert sum(r.rows for r in told) == 600 and max(r.bytes for r in told) < 5 << 20
