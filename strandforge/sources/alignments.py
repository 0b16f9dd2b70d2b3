"""Alignment XML (BLAST output format 5) as hit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_HSP = ("struct<`Hsp_num`:bigint,`Hsp_score`:double,`Hsp_evalue`:double,`Hsp_identity`:bigint,`Hsp_align-len`:bigint,"
        "`Hsp_query-frame`:int,`Hsp_hit-frame`:int>")
_HIT = f"struct<`Hit_num`:bigint,`Hit_id`:string,`Hit_def`:string,`Hit_hsps`:struct<`Hsp`:array<{_HSP}>>>"
SCHEMA = f"`Iteration_query-def` string, `Iteration_hits` struct<`Hit`:array<{_HIT}>>"


def scan_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Every HSP of one XML file or of a folder of batches; a query without hits gives one row of nulls.

    Documents without records give nothing. Columns: query_id (query up to the first ``|``), hit_rank, hsp_no,
    hit_id, hit_def, evalue, identity, score, query_frame, frame (of the hit).
    """
    records = spark.read.format("xml").option("rowTag", "Iteration").schema(SCHEMA).load(path)
    hits = records.select(F.substring_index(F.col("`Iteration_query-def`"), "|", 1).alias("query_id"),
                          F.posexplode_outer("Iteration_hits.Hit").alias("hit_rank", "hit"))
    hsps = hits.select("query_id", (F.col("hit_rank") + 1).cast("bigint").alias("hit_rank"), F.col("hit.Hit_id").alias("hit_id"),
                       F.col("hit.Hit_def").alias("hit_def"), F.posexplode_outer("hit.Hit_hsps.Hsp").alias("hsp_no", "h"))
    return hsps.select("query_id", "hit_rank", (F.col("hsp_no") + 1).cast("bigint").alias("hsp_no"), "hit_id", "hit_def",
                       F.col("h.Hsp_evalue").alias("evalue"),
                       (F.col("h.Hsp_identity") / F.col("h.`Hsp_align-len`").cast("double")).alias("identity"),
                       F.col("h.Hsp_score").alias("score"), F.col("h.`Hsp_query-frame`").alias("query_frame"),
                       F.col("h.`Hsp_hit-frame`").alias("frame"))
