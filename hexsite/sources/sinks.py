"""Sinks: tables that appear whole or not at all, gates before writing, exports, manifests."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexsite.operators.gates import GateFailed, passed


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on any file system, under another name first."""
    fs, p = _fs(spark, path)
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(own, True)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    # one step, so readers find the old file or the new one
    hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(own, p, how)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()["value"]


def write_generation(root: str, **tables: DataFrame) -> str:
    """All tables in a folder of their own, then one pointer to it: readers see all of them or none."""
    spark = next(iter(tables.values())).sparkSession
    generation = f"gen-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{root}/{generation}/{name}")
    write_text(spark, f"{root}/CURRENT", generation)
    return generation


def read_generation(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{read_text(spark, f'{root}/CURRENT').strip()}/{table}")


def write_if(df: DataFrame, path: str, report: DataFrame, report_path: str | None = None) -> None:
    """The report is written always, the table only if no gate fails."""
    spark = df.sparkSession
    rows = report.collect()
    if report_path:
        failed = [r["gate"] for r in rows if r["status"] == "FAIL"]
        write_text(spark, report_path, json.dumps({"gates": [r.asDict() for r in rows], "overall": "FAIL" if failed else "PASS"}, ensure_ascii=False))
    passed(rows)
    df.write.mode("overwrite").parquet(path)


def quarantine(df: DataFrame, good, path: str, rest: str) -> None:
    """Rows that are good, and all others, in two tables; null isn't good."""
    ok = F.coalesce(good, F.lit(False))
    df.filter(ok).write.mode("overwrite").parquet(path)
    df.filter(~ok).write.mode("overwrite").parquet(rest)


def list_text(c):
    """A list as ``['A', 'B']``; null and empty are ``[]``."""
    return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.concat(F.lit("['"), F.array_join(c, "', '"), F.lit("']"))).otherwise("[]")


def csv_with_bom(df: DataFrame, path: str) -> None:
    """UTF-8 CSV whose header begins with a byte order mark, for spreadsheets; lists are written as text."""
    cols = [list_text(F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    first = df.columns[0]
    df.select(*cols).withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option("header", True).csv(path)


def feature_lines(df: DataFrame, lat: str, lng: str) -> DataFrame:
    """A GeoJSON point feature a row, coordinates to six decimals, longitude first; NaN is null."""
    clean = [F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes if c not in (lat, lng)]
    shape = F.struct(F.lit("Point").alias("type"), F.array(F.round(lng, 6), F.round(lat, 6)).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*clean).alias("properties")), {"ignoreNullFields": "false"}).alias("value"))


def feature_collection(df: DataFrame, path: str, lat: str = "lat", lng: str = "lng", *, most: int = 100_000) -> None:
    """One FeatureCollection in one file, for viewers; for tables of up to ``most`` rows, which are counted first."""
    n = df.count()
    if n > most:
        raise ValueError(f"{n} rows of {most}: use geojson()")
    lines = [r["value"] for r in feature_lines(df, lat, lng).collect()]
    write_text(df.sparkSession, path, '{"type": "FeatureCollection", "features": [' + ",\n".join(lines) + "]}")


def dump_flagged(df: DataFrame, flags: str, wanted: list[str], path: str, columns: list[str]) -> None:
    """Rows with one of the flags, for eyes: CSV with a header."""
    from hexsite.functions.columns import has_any

    csv_with_bom(df.filter(has_any(F.col(flags), wanted)).select(*columns, flags), path)


def series_files(df: DataFrame, path: str, key: str, at: str) -> None:
    """Series partitioned by key, each sorted by time."""
    df.repartition(key).sortWithinPartitions(key, at).write.mode("overwrite").partitionBy(key).parquet(path)


def geojson(df: DataFrame, path: str, lat: str = "lat", lng: str = "lng") -> None:
    """Line-delimited features, in as many files as there are partitions."""
    feature_lines(df, lat, lng).write.mode("overwrite").text(path)


def tree_digest(files: DataFrame) -> DataFrame:
    """SHA-256 over ``path, size, sha256`` of all files of a manifest, in the order of their paths."""
    line = F.concat_ws("\t", F.col("path").cast("string"), F.col("size").cast("string"), "sha256")
    lines = F.array_sort(F.collect_list(F.struct("path", line.alias("line"))))
    return files.agg(F.sha2(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").cast("binary"), 256).alias("tree"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, size, sha256 of the files below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def bundle(spark: SparkSession, target: str, tables: dict[str, DataFrame], *, required: dict[str, list[str]], keys: dict[str, list[str]], forbidden: list[str] = ()) -> DataFrame:
    """A hand-off: tables are checked (columns, unique keys), written beside the target, listed with their digests and put in
    place in one step. A target that exists is never overwritten. Gives the manifest."""
    from hexsite.sources.readers import assert_schema

    fs, place = _fs(spark, target)
    if fs.exists(place):
        raise FileExistsError(target)
    own = f"{target}.{uuid.uuid4().hex}.tmp"
    for name, df in tables.items():
        assert_schema(df, required.get(name, []), forbidden)
        if name in keys and df.groupBy(*keys[name]).count().filter("count > 1").limit(1).count():
            raise ValueError(f"{name}: {keys[name]} repeat")
        df.write.parquet(f"{own}/{name}")
    rows = [(r["path"].rpartition(".tmp/")[2], r["size"], r["sha256"]) for r in manifest(spark, own).collect()]  # a row a file
    write_text(spark, f"{own}/MANIFEST.json", json.dumps({"files": [{"path": p, "size": n, "sha256": h} for p, n, h in sorted(rows)], "tree": tree_of(rows)}))
    if not fs.rename(_fs(spark, own)[1], place):
        raise OSError(f"{target} can't be put in place")
    return spark.createDataFrame(rows, "path string, size long, sha256 string")


def tree_of(rows: list[tuple[str, int, str]]) -> str:
    """SHA-256 over ``path, size, sha256`` of files in the order of their paths."""
    import hashlib

    return hashlib.sha256("\n".join(f"{p}\t{n}\t{h}" for p, n, h in sorted(rows)).encode()).hexdigest()


def freeze(spark: SparkSession, root: str, text: str, version: str) -> None:
    """A new MANIFEST.json; the one before is kept under its version, and a version is never written twice."""
    fs, now = _fs(spark, f"{root}/MANIFEST.json")
    if fs.exists(now):
        old = json.loads(read_text(spark, f"{root}/MANIFEST.json")).get("version", "unknown")
        kept = _fs(spark, f"{root}/MANIFEST-{old}.json")[1]
        if old == version or fs.exists(kept):
            raise FileExistsError(f"{root}: version {old}")
        if not fs.rename(now, kept):
            raise OSError(f"{root}: the manifest can't be kept")
    write_text(spark, f"{root}/MANIFEST.json", json.dumps({"version": version, **json.loads(text)}))


def verify_manifest(have: DataFrame, want: DataFrame) -> DataFrame:
    """One row a file that is missing, unexpected or different."""
    a, b = have.select("path", F.struct("size", "sha256").alias("h")), want.select("path", F.struct("size", "sha256").alias("w"))
    both = a.join(b, "path", "full")
    state = F.when(F.col("h").isNull(), "MISSING").when(F.col("w").isNull(), "UNEXPECTED").when(F.col("h") != F.col("w"), "DIFFERENT")
    return both.select("path", state.alias("state")).filter("state IS NOT NULL")


__all__ = ["GateFailed", "bundle", "csv_with_bom", "dump_flagged", "feature_collection", "feature_lines", "freeze", "geojson", "list_text", "manifest", "quarantine", "read_generation", "read_text", "series_files", "tree_digest", "tree_of", "verify_manifest", "write_generation", "write_if", "write_text"]
