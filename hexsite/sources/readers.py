"""Sources: declared schemas, pruned scans, series in directories, JSON, ordered merging, newest versions, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """Only the columns asked for are read."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.select(*columns) if columns else df


def partitioned(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Hive-partitioned dataset; the schema is declared, so codes such as 01 stay text."""
    return spark.read.schema(schema).parquet(path)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header, declared schema; a value that doesn't parse is null and its line is kept in ``_corrupt``."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(f"{schema}, _corrupt string").csv(path)


def text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text; empty is null."""
    return spark.read.option("header", True).option("nullValue", "").schema(", ".join(f"`{c}` string" for c in columns)).csv(path)


def series_directory(spark: SparkSession, path: str, schema: str, key: str = "station") -> DataFrame:
    """One CSV a series: its file's name, without ending, is its key."""
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.withColumn(key, F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]+$", 1))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array each."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def json_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a file; unreadable files are skipped and counted by the caller through ``_corrupt``."""
    return spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(f"{schema}, _corrupt string").json(path)


def features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of GeoJSON pages: properties, geometry as JSON text, and the page's file."""
    schema = f"type string, features array<struct<properties:struct<{properties}>, geometry:string>>"
    pages = spark.read.option("multiLine", True).schema(schema).json(path)
    return pages.select(F.explode("features").alias("f")).select("f.properties.*", F.col("f.geometry").alias("geometry"))


def in_order(*sources: DataFrame) -> DataFrame:
    """Sources with their rank, in the order given; columns that one lacks are null."""
    out = None
    for rank, df in enumerate(sources):
        df = df.withColumn("src_rank", F.lit(rank))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; an aggregate, so a repeated key is combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")


def merge_first(df: DataFrame, key: str, tab: str) -> tuple[DataFrame, DataFrame]:
    """(one tab of each key, counters): repeats within a tab and across tabs."""
    pairs = df.groupBy(key, tab).agg(F.count(F.lit(1)).alias("n"))
    each = pairs.groupBy(key).agg(F.min(tab).alias(tab), F.count(F.lit(1)).alias("tabs"), F.sum(F.col("n") - 1).alias("within"))
    counters = each.agg(F.sum("within").alias("within_tab"), F.sum(F.col("tabs") - 1).alias("across_tabs"), F.count(F.lit(1)).alias("codes"))
    return each.select(key, tab), counters


def newest(versions: DataFrame, path: str = "path", generation: str = "generation", usable: Column | None = None) -> str | None:
    """Path of the newest usable version."""
    df = versions if usable is None else versions.filter(usable)
    return df.agg(F.max_by(path, generation).alias("p")).first()["p"]


def first_readable(spark: SparkSession, candidates: list[tuple[str, list[str]]]) -> tuple[DataFrame, str]:
    """The first dataset that exists and has the columns asked for; a stale one is passed over."""
    from pyspark.errors import AnalysisException

    for path, columns in candidates:
        try:
            df = spark.read.parquet(path)
        except AnalysisException:
            continue
        if set(columns) <= set(df.columns):
            return df, path
    raise FileNotFoundError(", ".join(p for p, _ in candidates))


def well_formed(items: DataFrame, announced: int, key: str, kind: str, wanted: str) -> tuple[DataFrame, int]:
    """(the first row of each key, of the wanted kind; how many items had no key), if there are as many as announced."""
    whole = complete(items, announced)
    bad = whole.filter(F.col(key).isNull()).count()
    fit = whole.filter(F.col(key).isNotNull() & (F.col(kind) == wanted))
    return first_wins(fit, key, [c for c in fit.columns if c != key]), bad


def boundary_lines(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """(relation, ways, missing): outer ways of each relation, as a list of WKT-free point lists, and how many the table of ways
    lacks. ``relations``: relation, members array of (way, role); ``ways``: way, points. Two passes become one join."""
    outer = relations.select("relation", F.explode("members").alias("m")).filter("m.role = 'outer'").select("relation", F.col("m.way").alias("way")).distinct()
    met = outer.join(ways.select("way", "points"), "way", "left")
    return met.groupBy("relation").agg(F.collect_list("points").alias("ways"), F.count_if(F.col("points").isNull()).alias("missing"))  # a relation's own ways


def quadtree(box: tuple[float, float, float, float], ask, *, cap: int, smallest: float) -> list:
    """Items of a box (lat0, lng0, lat1, lng1) from a service that answers at most ``cap`` of them: ``ask`` gives a list, or
    None for an error; a box that fails or is full is asked for in four parts, down to tiles of ``smallest`` degrees, whose
    answer is taken as it is. Items of several tiles, known by (type, id), stand once."""
    found, todo = {}, [box]
    while todo:
        a, b, c, d = todo.pop()
        got = ask((a, b, c, d))
        if (got is None or len(got) >= cap) and max(c - a, d - b) > smallest:
            y, x = (a + c) / 2, (b + d) / 2
            todo += [(a, b, y, x), (a, x, y, d), (y, b, c, x), (y, x, c, d)]
        else:
            for item in got or []:
                found.setdefault((item["type"], item["id"]), item)
    return list(found.values())


def seed_grid(box: tuple[float, float, float, float], step_km: float) -> list[tuple[float, float]]:
    """Points over a box, rows staggered by half a step."""
    import math

    lat0, lng0, lat1, lng1 = box
    down = step_km * math.sqrt(3) / 2 / 111.32
    out, row, lat = [], 0, lat0
    while lat <= lat1 + 1e-12:
        across = step_km / (111.32 * math.cos(math.radians(lat)))
        lng = lng0 + (across / 2 if row % 2 else 0.0)
        while lng <= lng1 + 1e-12:
            out.append((lat, lng))
            lng += across
        row += 1
        lat = lat0 + row * down
    return out


def proven_radius(distances: list[float], cap: int) -> float:
    """What a reply of the nearest stations proves to be covered: a full one the disk of its farthest, a shorter one nothing."""
    return max(distances) if len(distances) >= cap else 0.0


#: declared sources: what they are, under which licence, and of which vintage
class Source:
    def __init__(self, name: str, members: list[str], licence: str, vintage: str):
        self.name, self.members, self.licence, self.vintage = name, members, licence, vintage


def missing_members(source: Source, present: set[str]) -> list[str]:
    """Declared members that aren't there, in order."""
    return [m for m in source.members if m not in present]


def telemetry_tier(path: str, tiers: dict[str, str], default: str, run: str | None = None) -> str:
    """The sampling tier a folder's name says; any other than the default one must be asked for by run, as tiers are never mixed."""
    tier = next((t for part, t in tiers.items() if part in path.split("/")), default)
    if tier != default and run is None:
        raise ValueError(f"{path} is of tier {tier}: name the run")
    return tier


def frozen(spark: SparkSession, path: str, fetch, *, refetch: bool = False) -> DataFrame:
    """The stored raw table if there is one; else, or if asked to, fetched and stored."""
    from pyspark.errors import AnalysisException

    if not refetch:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass
    fetch().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def complete(df: DataFrame, announced: int) -> DataFrame:
    """The rows, if they are as many as the source announced."""
    n = df.count()
    if n != announced:
        raise ValueError(f"{n} rows of {announced}")
    return df


def seeds(stations: DataFrame, known: DataFrame, key: str, statuses: list[str], valid: Column) -> DataFrame:
    """Live stations with valid coordinates that aren't known yet, once each."""
    return stations.filter(F.col("status").isin(statuses) & valid).join(known.select(key), key, "left_anti").dropDuplicates([key])


def assert_schema(df: DataFrame, required: list[str], forbidden: list[str] = ()) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    present = [c for c in forbidden if c in df.columns]
    if missing or present:
        raise ValueError(f"missing: {missing}, forbidden: {present}")
    return df
