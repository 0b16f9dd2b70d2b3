"""Ranks, first rows and picks per key that do not put a whole key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per(df: DataFrame, keys: list[str], order: list, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key. The row limit is applied on the map side before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def ranked(df: DataFrame, keys: list[str], block: Column, order: list, name: str = "rank") -> DataFrame:
    """1-based rank of every row in its key, with ``<name>_of`` rows in all.

    ``block`` must grow with ``order`` (for instance ``position div 65536``). Rows are numbered inside
    (key, block); block sizes, a small table, are summed up and added. No task sees a whole key.
    """
    parts = [*keys, "_block"]
    rows = df.withColumn("_block", block)
    sizes = rows.groupBy(*parts).agg(F.count("*").alias("_size"))
    run = Window.partitionBy(*keys).orderBy("_block")
    sizes = (sizes.withColumn("_before", F.sum("_size").over(run.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn(f"{name}_of", F.sum("_size").over(Window.partitionBy(*keys))))
    numbered = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    return (numbered.join(sizes, parts)
            .withColumn(name, F.col("_rn") + F.coalesce("_before", F.lit(0)))
            .drop("_rn", "_before", "_size", "_block"))


def middle_per(df: DataFrame, keys: list[str], block: Column, order: list) -> DataFrame:
    """The row at 0-based index ``count // 2`` of each key."""
    return (ranked(df, keys, block, order, "_rank")
            .filter(F.col("_rank") - 1 == F.floor(F.col("_rank_of") / 2)).drop("_rank", "_rank_of"))


def distinct_genes(rows: DataFrame, gene: str, order: str) -> DataFrame:
    """Each gene once, with the place where it first appears; the placeholder 0 is dropped."""
    return (rows.filter(F.col(gene).isNotNull() & (F.col(gene) != "0"))
            .groupBy(gene).agg(F.min(order).alias(order)))
