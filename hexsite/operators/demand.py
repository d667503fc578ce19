"""Demand on the hex grid: sums over rings, access tiers, settlement clusters and classes, mass-conserving moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexsite.config import DEFAULT, Thresholds
from hexsite.functions import grid
from hexsite.functions.columns import truth
from hexsite.operators.graph import components


def ring_sums(cells: DataFrame, value: str, rings: list[int]) -> DataFrame:
    """cell, value, and the sum over exactly ring k, for each k; cells that aren't in the table count as 0.

    Each cell gives its value to its neighbours, so it is one aggregate; run it on the whole grid, before clipping.
    """
    give = F.explode(F.array(*[F.struct((F.col("cell") + s).alias("to"), F.lit(k).alias("k")) for k in rings for s in grid.ring(k)])).alias("g")
    sums = cells.filter(F.col(value).isNotNull() & (F.col(value) != 0)).select(F.col(value).alias("v"), give).groupBy("g.to").agg(*[F.sum(F.when(F.col("g.k") == k, F.col("v"))).alias(f"ring{k}") for k in rings])
    out = cells.select("cell", value).join(sums, F.col("cell") == F.col("to"), "left")
    return out.select("cell", value, *[F.coalesce(f"ring{k}", F.lit(0.0)).alias(f"ring{k}") for k in rings])


def access_tier(own: Column, near: Column, far: Column) -> Column:
    """DIRECT with a road of its own, ADJACENT in ring 1, NEAR in ring 2, else ISOLATED."""
    return F.when(own > 0, "DIRECT").when(near > 0, "ADJACENT").when(far > 0, "NEAR").otherwise("ISOLATED")


def tier_summary(cells: DataFrame, tier: str = "access_tier", pop: str = "pop") -> DataFrame:
    """Of each access tier: cells, population and its share of all (0 of nothing)."""
    by = cells.groupBy(F.col(tier).alias("tier")).agg(F.count(F.lit(1)).alias("cells"), F.sum(pop).alias("pop"))
    all_ = by.agg(F.sum("pop").alias("_all"))
    return by.crossJoin(F.broadcast(all_)).select("tier", "cells", "pop", F.coalesce(F.try_divide(F.col("pop"), F.col("_all")), F.lit(0.0)).alias("share"))  # one row is broadcast


def tier_rank(tier: Column) -> Column:
    return F.when(tier == "DIRECT", 0).when(tier == "ADJACENT", 1).when(tier == "NEAR", 2).when(tier == "ISOLATED", 3).otherwise(4)


def clusters(cells: DataFrame, pop: str, density: float, least_total: float) -> DataFrame:
    """(cell, cluster, cluster_pop, cluster_cells, cluster_rank) of connected cells of at least a density and a total.

    The cluster is named by its least cell; rank 0 is the most populous.
    """
    dense = cells.filter(F.col(pop) / grid.AREA_KM2 >= density).select("cell", pop)
    next_ = dense.select("cell", F.explode(F.array(*[F.col("cell") + s for s in grid.ring(1)])).alias("b")).filter("b > cell")
    edges = next_.join(dense.select(F.col("cell").alias("b")), "b").select(F.col("cell").alias("a"), "b")
    named = dense.join(components(edges), F.col("cell") == F.col("node"), "left").select("cell", pop, F.coalesce("component", "cell").alias("cluster"))
    totals = named.groupBy("cluster").agg(F.sum(pop).alias("cluster_pop"), F.count(F.lit(1)).alias("cluster_cells")).filter(F.col("cluster_pop") >= least_total)
    ranked = totals.withColumn("cluster_rank", F.row_number().over(Window.orderBy(F.desc("cluster_pop"), "cluster")) - 1)  # a row a cluster
    return named.join(ranked, "cluster").select("cell", "cluster", "cluster_pop", "cluster_cells", "cluster_rank")


def tiers_for(cells: DataFrame, roads: DataFrame, access: str = "road_access") -> DataFrame:
    """(cell, access_tier) of any cells, looked up in the whole road table: a cell that isn't in it has no road of its own,
    which says nothing of the cells around it."""
    there = roads.select("cell", F.col(access).alias("road"))
    base = cells.select("cell").distinct().join(there, "cell", "left").withColumn("road", F.coalesce("road", F.lit(0.0)))
    give = F.explode(F.array(*[F.struct((F.col("cell") + s).alias("to"), F.lit(k).alias("k")) for k in (1, 2) for s in grid.ring(k)])).alias("g")
    sums = there.filter("road <> 0").select("road", give).groupBy("g.to").agg(F.sum(F.when(F.col("g.k") == 1, F.col("road"))).alias("near"), F.sum("road").alias("far"))
    both = base.join(sums, F.col("cell") == F.col("to"), "left")
    return both.select("cell", access_tier(F.col("road"), F.col("near"), F.col("far")).alias("access_tier"))


def degree_of_urbanisation(cells: DataFrame, pop: str, t: Thresholds = DEFAULT) -> DataFrame:
    """settlement_class, URBAN_CENTRE in a dense cluster, else URBAN_CLUSTER in an urban one, else RURAL; and the cluster's and
    the centre's number (from 0, the most populous; -1: in none), population and cells."""
    out = cells
    for name, density, total in (("cluster", t.urban_per_km2, t.urban_total), ("centre", t.dense_per_km2, t.dense_total)):
        c = clusters(cells, pop, density, total)
        c = c.select("cell", F.col("cluster_rank").alias(f"{name}_id"), F.col("cluster_pop").alias(f"{name}_pop"), F.col("cluster_cells").alias(f"{name}_n_cells"))
        out = out.join(c, "cell", "left").fillna(-1, [f"{name}_id"]).fillna(0, [f"{name}_pop", f"{name}_n_cells"])
    return out.withColumn("settlement_class", F.when(F.col("centre_id") >= 0, "URBAN_CENTRE").when(F.col("cluster_id") >= 0, "URBAN_CLUSTER").otherwise("RURAL"))


def reallocate(cells: DataFrame, *, commune="commune", pop="pop", source: Column, built="built", receiver: Column, census: str | None = None, commune_pop: str | None = None, t: Thresholds = DEFAULT) -> DataFrame:
    """Population of source cells is moved to their commune's receivers, in proportion to built-up land.

    With ``census`` (and ``commune_pop``, the commune's population as estimated) a commune that is estimated at over
    ``retotal_ratio`` of its census gives its receivers only min(1, census_ratio / ratio) of what is moved. Without a
    commune, or without receivers in it, a source keeps its population and says why. Sums of a commune come from one
    aggregate, so a large commune isn't sorted anywhere.
    """
    over = F.col(commune_pop) / F.col(census) if census else F.lit(None).cast("double")
    cut = F.when(truth((F.col(census) > 0) & (over > t.retotal_ratio)), F.least(F.lit(1.0), F.lit(t.census_ratio) / over)).otherwise(F.lit(1.0)) if census else F.lit(1.0)
    marked = cells.withColumn("_s", truth(source) & truth(F.col(pop) > 0)).withColumn("_r", truth(receiver) & truth(F.col(built) > 0))
    sums = marked.filter(F.col(commune).isNotNull()).groupBy(commune).agg(F.sum(F.when(F.col("_s"), F.col(pop)).otherwise(0.0)).alias("_removed"), F.sum(F.when(F.col("_r"), F.col(built)).otherwise(0.0)).alias("_built"), F.min(F.when(F.col("_s"), cut)).alias("_cut"))
    out = marked.join(sums, commune, "left")
    can = truth(F.col("_built") > 0) & truth(F.col("_removed") > 0)
    share = F.when(F.col("_r") & can, F.col("_removed") * F.col("_cut") * F.col(built) / F.col("_built")).otherwise(0.0)
    moved = F.when(F.col("_s") & can, 0.0).otherwise(F.col(pop)) + share
    why = F.when(~F.col("_s"), "WORLDPOP").when(F.col(commune).isNull(), "UNREPAIRED_NO_COMMUNE").when(~can, "UNREPAIRED_NO_ACCESSIBLE_BUILTUP").otherwise("MOVED_TO_ACCESSIBLE")
    return out.withColumn("pop_new", moved).withColumn("pop_src", why).drop("_s", "_r", "_removed", "_built", "_cut")


def without_noise(cells: DataFrame, *, commune="commune", pop="pop", road="road_access") -> DataFrame:
    """Cells that have a commune, population or a road; null counts as none."""
    return cells.filter(F.col(commune).isNotNull() | truth(F.col(pop) > 0) | truth(F.col(road) > 0))


def implausible(t: Thresholds = DEFAULT) -> Column:
    """Cells whose population stands on too few pixels (see stats.concentration)."""
    return (F.col("largest") > t.pixel_max) | ((F.col("total") > t.cell_pop) & (F.col("top3_share") > t.top3_share))


def land_support(t: Thresholds = DEFAULT) -> dict[str, Column]:
    """Population that stands on water or where next to nothing is built."""
    return {"POP_ON_WATER": (F.col("frac_water") > 0.8) & (F.col("pop") > 100), "POP_NO_BUILT": (F.col("built") < 0.02) & (F.col("pop") > 500)}


def merge_layers(*layers: DataFrame, on: str = "cell") -> DataFrame:
    """Full outer join of layers; measures that are missing are 0."""
    out = layers[0]
    for x in layers[1:]:
        out = out.join(x, on, "full")
    return out.fillna(0)


def retotal(cells: DataFrame, *, commune="commune", pop="pop", built="built", bad: Column, census: str = "census", empty: DataFrame | None = None, t: Thresholds = DEFAULT) -> DataFrame:
    """Communes with a bad cell are dealt out anew over their built-up land: all their cells give up their population, and
    its sum, or what the census allows where there is one over 0 and the sum is far over it, is shared by built-up area.

    ``empty``: (cell, commune, built) of built-up cells that the table may lack; those it lacks receive too, and become rows
    of population 0 before; one in two communes gets both shares. Without built-up land nothing moves and the bad cells say so.
    """
    marked = cells.withColumn("_bad", truth(bad)).withColumn("_new", F.lit(False))
    if empty is not None:
        more = empty.select("cell", F.col(commune), F.col(built)).join(cells.select("cell"), "cell", "left_anti").filter(F.col(commune).isNotNull() & (F.col(built) > 0))
        marked = marked.unionByName(more.withColumn(pop, F.lit(0.0)).withColumn("_bad", F.lit(False)).withColumn("_new", F.lit(True)), allowMissingColumns=True)
    sums = marked.filter(F.col(commune).isNotNull()).groupBy(commune).agg(F.bool_or("_bad").alias("_any"), F.sum(pop).alias("_pop"), F.sum(built).alias("_built"), F.max(census).alias("_census"))
    out = marked.join(sums, commune, "left")
    hit, can = truth("_any"), truth(F.col("_built") > 0)
    far = truth((F.col("_census") > 0) & (F.col("_pop") > t.retotal_ratio * F.col("_census")))
    target = F.when(far, t.census_ratio * F.col("_census")).otherwise(F.col("_pop"))
    new = F.when(hit & can, target * F.coalesce(F.col(built), F.lit(0.0)) / F.col("_built")).otherwise(F.col(pop))
    why = F.when(hit & can, F.when(far, "RETOTALED_DANSO").otherwise("REDISTRIBUTED")).when(F.col("_bad") & F.col(commune).isNotNull(), "UNREPAIRED_NO_BUILTUP").otherwise("WORLDPOP")
    out = out.withColumn("pop_new", new).withColumn("pop_src", why)
    old = out.filter("NOT _new").drop("_bad", "_any", "_pop", "_built", "_census", "_new")
    if empty is None:
        return old
    got = out.filter(F.col("_new") & hit & can).groupBy("cell").agg(F.min(commune).alias(commune), F.sum(built).alias(built), F.sum("pop_new").alias("pop_new"), F.min("pop_src").alias("pop_src"))
    return old.unionByName(got.withColumn(pop, F.lit(0.0)), allowMissingColumns=True)
