"""Written tables that no plan reads any more are deleted before the next large one is made."""

import hashlib
import os

from strandforge import session
from strandforge.llm import suffix_dedup


def test_suffix_dedup_leaves_one_written_table(spark):
    repeat = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(4))
    texts = [repeat, "first " + repeat + " end", repeat, None, "short", "x" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    before = len(session._SCRATCH)
    out = suffix_dedup.dedup_bytes(docs)
    left = [path for _, path in session._SCRATCH[before:]]
    assert len(left) == 1 and os.path.basename(left[0]).startswith("cuts-")
    got = {r.doc_id: (bytes(r.kept).decode(), r.n_bytes, r.n_removed, r.n_spans) for r in out.collect()}
    assert got == {0: (repeat, 256, 0, 0), 1: ("first  end", 266, 256, 1), 2: ("", 256, 256, 1), 3: ("", 0, 0, 0), 4: ("short", 5, 0, 0),
                   5: ("x", 300, 299, 1)}


def test_a_dropped_table_is_gone_and_forgotten(spark):
    told = session.cut_lineage(spark.range(10), "gone")
    assert os.path.isdir(told.scratch)
    session.drop_cuts(told)
    assert not os.path.exists(told.scratch) and told.scratch not in [path for _, path in session._SCRATCH]
