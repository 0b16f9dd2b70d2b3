"""Alignment hits: summaries, gates and what they say about a site.

Everything a decision needs is a count or a flag per site, so hits are aggregated on the map side and a site
with very many hits costs no more than one with a few. Only ``hit_report`` makes lists, which are its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ranking import ranked


def hit_summary(hits: DataFrame, query: str, queries: DataFrame | None = None) -> DataFrame:
    """Smallest e-value, largest identity and number of HSPs per query.

    With ``queries`` given, those without hits appear with an infinite e-value, identity 0 and count 0.
    """
    got = hits.filter(F.col("hit_def").isNotNull()).groupBy(query).agg(
        F.min("evalue").alias("evalue"), F.max("identity").alias("identity"), F.count("*").alias("alignment_count"))
    if queries is None:
        return got
    return (queries.select(query).distinct().join(got, query, "left")
            .select(query, F.coalesce("evalue", F.lit(float("inf"))).alias("evalue"),
                    F.coalesce("identity", F.lit(0.0)).alias("identity"),
                    F.coalesce("alignment_count", F.lit(0).cast("bigint")).alias("alignment_count")))


def hit_report(hits: DataFrame, query: str, order: list[str], queries: DataFrame | None = None) -> DataFrame:
    """Earlier report: alignments, accessions and descriptions joined by ``|``, strands by ``,``.

    One row per alignment is expected (its first HSP). The lists are as long as the aligner's limit on hits
    per query; use ``hit_summary`` and ``wanted_sieve`` where there is no such limit.
    """
    accession = F.split("hit_id", r"\|")[3]
    got = hits.groupBy(query).agg(F.sort_array(F.collect_list(F.struct(
        *order, accession.alias("_acc"), F.col("hit_def").alias("_def"), F.col("frame").cast("string").alias("_frame")))).alias("h"))

    def joined(c: str, sep: str) -> Column:
        return F.array_join(F.transform("h", lambda x: x[c]), sep)

    got = got.select(query, F.size("h").cast("bigint").alias("align_num"), joined("_acc", "|").alias("align_accession"),
                     joined("_def", "|").alias("align_descrip"), joined("_frame", ",").alias("plus_minus"))
    if queries is None:
        return got
    return queries.select(query).distinct().join(got, query, "left").fillna(0, ["align_num"])


def score_gate(hits: DataFrame, query: str, queries: DataFrame, limit: float = 18.0) -> DataFrame:
    """One flag per query: no HSP scores ``limit`` or more."""
    best = hits.groupBy(query).agg(F.max("score").alias("best"))
    return (queries.select(query).distinct().join(best, query, "left")
            .select(query, (F.coalesce("best", F.lit(0.0)) < limit).alias("passed")))


def numbered_sites(sites: DataFrame, block: Column, order: list, gene: str = "gene") -> DataFrame:
    """Adds ``query_id`` = gene_n, n being the place of the site in its gene."""
    return (ranked(sites, [gene], block, order, "_n")
            .withColumn("query_id", F.concat(F.col(gene), F.lit("_"), F.col("_n").cast("string"))).drop("_n", "_n_of"))


def sites_with_hits(sites: DataFrame, summary: DataFrame) -> DataFrame:
    """Sites with the hit summary of their ``query_id``; ``matched`` is false for those no record speaks of."""
    return (sites.join(summary.withColumn("matched", F.lit(True)), "query_id", "left")
            .withColumn("matched", F.coalesce("matched", F.lit(False))))


def same_gene(gene: Column, hit_def: Column) -> Column:
    """The lower-case gene, or any of its ``_`` parts, occurs in the lower-case hit text."""
    g, d = F.lower(gene), F.lower(hit_def)
    return F.contains(d, g) | F.exists(F.split(g, "_"), lambda part: F.contains(d, part))


def complementary(frame: Column, identity: Column) -> Column:
    """Hit on the other strand; where the frame says nothing, an identity above 0.95."""
    return F.when(frame == -1, True).when(frame == 1, False).otherwise(F.coalesce(identity > 0.95, F.lit(False)))


def names_any(text: Column, names: list[str]) -> Column:
    found = F.lit(False)
    for n in names:
        found = found | F.contains(F.lower(text), F.lit(n.lower()))
    return found


def specificity(sites: DataFrame, hits: DataFrame, key: str, organisms: list[str], require: bool = True) -> DataFrame:
    """Sites that stay: a hit in a target organism, none of those to another gene, one complementary to the own gene.

    Hits of other organisms are dropped before the join. Without ``require`` every site with a record stays.
    """
    if not require:
        return sites.join(hits.select(key).distinct(), key, "left_semi")
    there = hits.filter(names_any(F.col("hit_def"), organisms)).select(key, "hit_def", "frame", "identity")
    flags = (there.join(sites.select(key, "gene"), key)
             .withColumn("same", same_gene(F.col("gene"), F.col("hit_def")))
             .groupBy(key).agg(F.count("*").alias("target_hits"), F.count_if(~F.col("same")).alias("other_gene_hits"),
                               F.bool_or(F.col("same") & complementary(F.col("frame"), F.col("identity"))).alias("compl")))
    return sites.join(flags.filter("other_gene_hits = 0 AND compl").select(key, "target_hits"), key)


def wanted_sieve(sites: DataFrame, hits: DataFrame, key: str, genes: DataFrame, molecule: str | None = "mRNA",
                 base_gene: Column | None = None) -> DataFrame:
    """Adds ``reason``: ``wanted``, or the first test a site fails.

    Tests in order: gene listed; molecule type (unless None); has hits; no hit names the organism but not the
    gene; a hit on the minus strand. ``base_gene`` is the name looked for (default: up to the first ``-``).
    """
    name = base_gene if base_gene is not None else F.substring_index("gene", "-", 1)
    listed = genes.select(F.upper("gene_name").alias("_g")).distinct().withColumn("_listed", F.lit(True))
    rows = sites.withColumn("_name", name).withColumn("_g", F.upper("gene")).join(listed, "_g", "left").drop("_g")
    flags = (hits.select(key, "hit_def", "frame").join(rows.select(key, "organism", "_name"), key).groupBy(key).agg(
        F.bool_or(F.contains("hit_def", "organism") & ~F.contains("hit_def", "_name")).alias("_other"),
        F.bool_or(F.col("frame") == -1).alias("_minus")))
    rows = rows.join(flags, key, "left")
    reason = F.when(F.col("_listed").isNull(), "not in gene list")
    if molecule:
        reason = reason.when(F.col("mol_type") != molecule, f"not {molecule}")
    reason = (reason.when(F.col("_other").isNull(), "not found").when(F.col("_other"), "not specific")
              .when(~F.col("_minus"), "not plus/minus").otherwise("wanted"))
    return rows.withColumn("reason", reason).drop("_name", "_listed", "_other", "_minus")
