"""Connectors of stations: parsing, roll-ups, cabinets, installed capacity from several sources, imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexsite.config import DEFAULT
from hexsite.functions.columns import power_label, truth, with_flag

def groups_of(payload: str) -> Column:
    """(watts, guns) groups of a JSON list; elements that are no objects, fields that are no whole numbers, and groups with
    neither watts nor guns, are skipped; so is all of a text that is no list."""
    field = lambda g, name: F.get_json_object(g, f"$.{name}")
    number = lambda g, name: F.coalesce(field(g, name).try_cast("bigint"), F.when(field(g, name).isNull(), F.lit(0)))
    raw = F.transform(F.from_json(payload, "array<string>"), lambda g: F.struct(number(g, "type").alias("w"), number(g, "totalEvse").alias("n")))
    return F.coalesce(F.filter(raw, lambda g: g["w"].isNotNull() & g["n"].isNotNull() & ((g["w"] > 0) | (g["n"] > 0))), F.array().cast("array<struct<w:bigint,n:bigint>>"))


# Plugs of cars.
CAR_STANDARDS = ["CCS2", "TYPE2"]


def explode_groups(df: DataFrame, station: str, payload: str, ac_max_kw: float = DEFAULT.ac_max_kw) -> DataFrame:
    """One row a kept group, numbered from 0 over kept groups (ids count from 1): id, current by power, label, guns."""
    out = df.select(station, F.posexplode(groups_of(payload)).alias("idx", "g")).select(station, "idx", (F.col("g.w") / 1000).alias("kw"), F.greatest(F.col("g.n"), F.lit(0)).alias("n"))
    current = F.when((F.col("kw") > 0) & (F.col("kw") <= ac_max_kw), "AC").otherwise("DC")
    return out.withColumn("current_type", current).withColumn("label", power_label(F.col("current_type"), F.col("kw"))).withColumn("connector_id", F.concat(F.col(station).cast("string"), F.lit("-c"), (F.col("idx") + 1).cast("string")))


def first_standard(registry: DataFrame, *, code="code", kw="kw", standard="standard", current="current", order: list[str]) -> DataFrame:
    """(code, kw1, standard, current): of a registry's connectors, the first of each code and power, to one decimal."""
    return registry.groupBy(F.col(code).alias("code"), F.round(kw, 1).alias("kw1")).agg(F.min_by(F.struct(F.col(standard).alias("standard"), F.col(current).alias("current")), F.struct(*order)).alias("_f")).select("code", "kw1", "_f.*")


def with_standard(connectors: DataFrame, first: DataFrame, *, code="code", kw="kw") -> DataFrame:
    """Plug, current and vehicle class: the registry's where it has the code and power, else UNKNOWN and by power.

    A group of power 0 has neither a current nor a label.
    """
    f = first.select(F.col("code").alias("_code"), F.col("kw1").alias("_kw"), F.col("standard"), F.col("current"))
    out = connectors.join(f, (F.col(code) == F.col("_code")) & (F.round(kw, 1) == F.col("_kw")), "left").drop("_code", "_kw")
    current = F.when(F.col(kw) > 0, F.coalesce("current", "current_type"))
    out = out.withColumn("connector_standard", F.coalesce("standard", F.lit("UNKNOWN"))).withColumn("current_type", current).drop("standard", "current")
    return out.withColumn("vehicle_class", F.when(F.col("connector_standard").isin(CAR_STANDARDS), "CAR").otherwise("UNVERIFIED")).withColumn("label", power_label(F.col("current_type"), F.col(kw)))


def vehicle_class(stations: DataFrame, connectors: DataFrame, by: str = "station") -> DataFrame:
    """CAR if all connectors of a station are a car's, else UNVERIFIED; UNKNOWN without connectors."""
    one = connectors.groupBy(by).agg(F.every(truth(F.col("vehicle_class") == "CAR")).alias("_all"))
    return stations.join(one, by, "left").withColumn("vehicle_class", F.when(F.col("_all"), "CAR").when(~F.col("_all"), "UNVERIFIED").otherwise("UNKNOWN")).drop("_all")


LOCATION = "struct<id:string,evses:array<struct<uid:string,physical_reference:string,status:string,connectors:array<struct<id:string,standard:string,power_type:string,max_electric_power:double>>>>>"


def flattened(locations: DataFrame, payload: str) -> DataFrame:
    """A row for each connector of each charge point of a location's JSON: store, evse, cabinet, status, connector, standard, kw, is_dc.

    Locations without charge points, and points without connectors, give no row; what doesn't parse neither.
    """
    one = locations.select(F.from_json(payload, LOCATION).alias("l")).select(F.col("l.id").alias("store"), F.explode("l.evses").alias("e"))
    two = one.select("store", F.col("e.uid").alias("evse"), F.col("e.physical_reference").alias("cabinet"), F.col("e.status").alias("status"), F.explode("e.connectors").alias("c"))
    return two.select("store", "evse", "cabinet", "status", F.col("c.id").alias("connector"), F.col("c.standard").alias("standard"), (F.col("c.max_electric_power") / 1000).alias("kw"), truth(F.upper("c.power_type").startswith("DC")).alias("is_dc"))


def current_of(ac: Column, dc: Column) -> Column:
    return F.when(ac & dc, "MIXED").when(ac, "AC").when(dc, "DC")


def rollup(guns: DataFrame, by: str = "station") -> DataFrame:
    """Current, largest and total power, guns and sorted labels of each station; one pass, combined before the shuffle."""
    return guns.groupBy(by).agg(
        current_of(F.bool_or(F.col("current_type") == "AC"), F.bool_or(F.col("current_type") == "DC")).alias("current_type"),
        F.max("kw").alias("max_kw"),
        F.sum(F.col("kw") * F.col("n")).alias("total_kw"),
        F.sum("n").alias("n_guns"),
        F.array_sort(F.collect_set(power_label(F.col("current_type"), F.col("kw")))).alias("labels"),
    )


def attach(stations: DataFrame, rolled: DataFrame, by: str = "station") -> DataFrame:
    """Left join; a station without connectors has 0 guns and no labels, the rest is unknown."""
    out = stations.join(rolled, by, "left")
    return out.withColumn("n_guns", F.coalesce("n_guns", F.lit(0))).withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))


def cabinets(guns: DataFrame, *, by="station", cabinet="cabinet", row="idx") -> DataFrame:
    """Two levels: power of a cabinet is its largest gun's; a gun without cabinet is one of its own."""
    key = F.coalesce(F.col(cabinet).cast("string"), F.concat(F.lit("row-"), F.col(row).cast("string")))
    one = guns.groupBy(by, key.alias("cab")).agg(F.max("kw").alias("cab_kw"), F.count(F.lit(1)).alias("cab_n"), F.sum("kw").alias("sum_kw"))
    return one.groupBy(by).agg(F.sum("cab_n").alias("guns"), F.max("cab_kw").alias("max_kw"), F.sum("sum_kw").alias("nameplate_kw"), F.sum("cab_kw").alias("site_kw"), F.bool_or(F.col("cab_n") > 1).alias("shared"))


def resolve_assets(df: DataFrame) -> DataFrame:
    """Installed capacity from the registry (reg_*), the live source (live_*) and telemetry (witness): the largest of
    lower bounds, and which source says so. Unknown stays null, never 0. With reg_current and live_current, current_type
    is the registry's, else the live one, and a difference of both is flagged."""
    reg, live, seen = F.col("reg_guns"), F.coalesce("live_guns", F.lit(0)), F.coalesce("witness", F.lit(0))
    source = F.when(reg.isNotNull(), "OFFICIAL").when(live > 0, "EVCS_LIVE").when(seen > 0, "TELEMETRY_BOUND").otherwise("UNKNOWN")
    known = F.col("config_src") != "UNKNOWN"
    nameplate = F.coalesce("reg_nameplate_kw", "live_total_kw")
    out = df.withColumn("config_src", source).withColumn("config_resolved", F.col("config_src").isin("OFFICIAL", "EVCS_LIVE"))
    out = out.withColumn("n_guns_installed", F.when(known, F.greatest(F.coalesce(reg, F.lit(0)), live, seen)))
    out = out.withColumn("nameplate_kw", F.when(known, nameplate)).withColumn("site_kw", F.when(known, F.coalesce("reg_site_kw", nameplate)))
    conditions = [(reg > live, "TRUNCATED"), (~known, "UNKNOWN"), (F.col("config_src") == "TELEMETRY_BOUND", "LOWER_BOUND"), (truth("reg_shared"), "CABINET")]
    if {"reg_current", "live_current"} <= set(df.columns):
        out = out.withColumn("current_type", F.when(known, F.coalesce("reg_current", "live_current")))
        conditions.append((F.col("reg_current") != F.col("live_current"), "CURRENT_TYPE"))
    flags = F.array().cast("array<string>")
    for condition, flag in conditions:
        flags = with_flag(flags, condition, flag)
    return out.withColumn("flags", flags)


def impute_median(df: DataFrame, *, value: str, levels: list[list[str]], least: float = 1.0) -> DataFrame:
    """``imputed``: the value, else the median of the first level that has one (the last may be all rows), half to even."""
    out = df
    for i, keys in enumerate(levels):
        medians = df.filter(F.col(value).isNotNull()).groupBy(*[F.col(k).alias(f"_{i}{k}") for k in keys]).agg(F.percentile(value, 0.5).alias(f"_m{i}"))
        out = out.join(medians, [F.col(k) == F.col(f"_{i}{k}") for k in keys], "left") if keys else out.crossJoin(F.broadcast(medians))  # one row
        out = out.drop(*[f"_{i}{k}" for k in keys])
    found = F.coalesce(*[F.col(f"_m{i}") for i in range(len(levels))])
    return out.withColumn("imputed", F.coalesce(F.col(value).cast("double"), F.bround(F.greatest(found, F.lit(least)), 0))).drop(*[f"_m{i}" for i in range(len(levels))])
