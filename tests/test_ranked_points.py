"""Designs that are ranked where they are made, and variants that are listed once."""

import random

import pytest
from pyspark.sql import functions as F

from checks import inputs
from strandforge.operators import variants

from .test_core import dna


def test_packed_ranks_equal_those_of_the_window(spark):
    rng = random.Random(41)
    texts = [dna(rng, n) for n in (101, 104, 60, 41, 20, 33)] + ["ACGTN" * 15, None]
    rows = [(i, s, 40, 41, e) for i, s in enumerate(texts) for e in (0.0,)]
    # points that share their key are ranked together; a key may be null
    rows += [(0, texts[1], 40, 41, 0.0), (0, texts[6], 40, 41, 0.0), (None, texts[0], 30, 31, 0.0), (None, texts[2], 30, 31, -1.25), (3, texts[0], None, None, 0.0)]
    points = spark.createDataFrame(rows, "doc_id INT, target STRING, pos5 BIGINT, pos3 BIGINT, mfe DOUBLE")
    key = ["doc_id", "pos5"]
    packed = variants.rank_designs(variants.arm_grid(points, mfe="mfe", by=key), key)
    plain = variants.rank_designs(variants.arm_grid(points, mfe="mfe"), key)
    ordered = ["doc_id", "pos5", "rank", "score", "arm5_len", "arm3_len"]
    got, want = (sorted(map(str, x.select(ordered).collect())) for x in (packed, plain))
    assert got == want and len(got) > 800
    whole = ["doc_id", "pos5", "arm5_len", "arm3_len", "tm5", "tm3", "bds5", "bds3", "score"]
    assert sorted(map(str, packed.select(whole).collect())) == sorted(map(str, plain.select(whole).collect()))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1  # points are shuffled, not their designs
    with pytest.raises(ValueError):
        variants.rank_designs(variants.arm_grid(points, by=["doc_id"]), key)


def test_texts_of_arms_are_made_only_where_asked_for(spark):
    points = spark.createDataFrame([(1, dna(random.Random(2), 101), 50, 51)], "doc_id INT, target STRING, pos5 BIGINT, pos3 BIGINT")
    best = variants.arm_grid(points, best=3)
    plan = best.select("doc_id", "arm5_len", "score")._jdf.queryExecution().optimizedPlan().toString()
    assert "pythonUDF0" in plan and "pythonUDF1" not in plan and "bds5" not in plan
    assert len(best.select("bds5").collect()) == 3


def test_what_makes_variants_is_done_once(spark):
    rng, text = random.Random(42), dna(random.Random(1), 3000)
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for rb in batches:
            made.add(rb.num_rows)
            yield rb

    rows = [("g", 1 + 101 * i, 1 + 101 * i + (1200 if i == 3 else 0), "A", "C", 1) for i in range(15)]
    v = spark.createDataFrame(rows, "gene STRING, v_start BIGINT, v_end BIGINT, ref STRING, alt STRING, strand INT")
    regions = spark.createDataFrame([("g", text)], "gene STRING, seq STRING")
    local = variants.with_local(v.mapInArrow(counted, v.schema), regions=regions).collect()
    assert made.value == len(rows) == len(local)
    assert all(r.local == text[max(r.v_start - 51, 0):r.v_end + 50] for r in local)


def test_listed_places_equal_those_with_the_text(spark, tmp_path):
    rng = random.Random(43)
    docs = [(i, "s", dna(rng, n)) for i, n in enumerate([0, 1, 2, 101, 102, 103, 203, 500, 40])] + [(None, "s", dna(rng, 300)), (-7, "s", dna(rng, 300)), (5, "s", None)]
    spark.createDataFrame(docs, "doc_id BIGINT, source STRING, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    old = inputs.variants_along(spark, str(tmp_path)).drop("seq")
    new = inputs.variants_apart(spark, str(tmp_path)).select(old.columns)
    assert [(f.name, f.dataType) for f in new.schema] == [(f.name, f.dataType) for f in old.schema]
    assert sorted(map(str, new.collect())) == sorted(map(str, old.collect())) and old.count() > 25
