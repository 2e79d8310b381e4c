"""Readers and writers of the formats that the access domain uses; every schema is declared, none inferred."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.functions import expr as X
from tractlake.functions import geometry as G
from tractlake.operators import shapes
from tractlake.operators.keeping import cut

POINT_SCHEMA = "type string, features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: array<double>>>>"
SAMPLES = "utc string, elapsed_s double, rss_bytes bigint"


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", **options) -> DataFrame:
    """A file with a header; the byte order mark that some publishers put first is not part of the first name."""
    return spark.read.csv(path, schema=schema, sep=sep, header=True, enforceSchema=True, encoding="UTF-8", **options)


def trimmed(df: DataFrame) -> DataFrame:
    """Every text cell trimmed, blanks null."""
    return df.select(*[X.blank_to_null(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def geojson_points(spark: SparkSession, path: str) -> DataFrame:
    """properties and x, y of the point features of a collection."""
    f = spark.read.schema(POINT_SCHEMA).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return f.select(F.col("f.properties").alias("properties"), F.get("f.geometry.coordinates", F.lit(0)).alias("x"), F.get("f.geometry.coordinates", F.lit(1)).alias("y"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path, length and sha256 of each file below a folder. A file is one row, so none may reach 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def read_ranges(rows: Iterable[pd.DataFrame], leaf: int) -> Iterable[pd.DataFrame]:
    """(path, leaf, digest) of every leaf of the ranges (path, start, stop) of files, read one leaf at a time."""
    for batch in rows:
        out = []
        for path, start, stop in zip(batch["path"], batch["start"], batch["stop"], strict=True):
            store, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
            with store.open_input_file(name) as file:
                out += [(path, at // leaf, hashlib.sha256(file.read_at(min(leaf, stop - at), at)).digest()) for at in range(start, stop, leaf)]
        yield pd.DataFrame(out, columns=["path", "leaf", "digest"])


def tree_digests(spark: SparkSession, path: str, leaf: int = 1 << 20, leaves_a_split: int = 64, fan: int = 1024) -> DataFrame:
    """path, length and tree_sha256 of each file below a folder, of files of any size.

    A file is dealt out as ranges of whole leaves of a fixed size; each leaf has a SHA-256, each `fan` digests in a row have one of their own, and so on up to
    one for the file. So the digest doesn't depend on how many leaves a task reads, and no task holds more than a leaf or a row of digests. Files are
    listed by Spark, which passes over empty ones, and read through Arrow's file systems, so their store has to be one of those.
    """
    files = cut(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length"))
    step = leaf * leaves_a_split
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step))).alias("k"))
    ranges = ranges.select("path", (F.col("k") * step).alias("start"), F.least((F.col("k") + 1) * step, "length").alias("stop")).repartition("path", "start")
    level = ranges.mapInPandas(lambda rows: read_ranges(rows, leaf), "path string, leaf long, digest binary")
    level = cut(level.join(files.select("path", F.ceil(F.col("length") / leaf).alias("many")), "path"))
    while not level.where("many > 1").isEmpty():
        row = F.array_sort(F.collect_list(F.struct("leaf", F.hex("digest").alias("d"))))  # fan digests at most
        up = level.groupBy("path", "many", F.floor(F.col("leaf") / fan).alias("up")).agg(row.alias("r"), F.first("digest").alias("own"))
        one = F.unhex(F.sha2(F.unhex(F.array_join(F.transform("r", lambda x: x["d"]), "")), 256))
        level = cut(up.select("path", F.col("up").alias("leaf"), F.when(F.col("many") > 1, one).otherwise(F.col("own")).alias("digest"), F.ceil(F.col("many") / fan).alias("many")))
    return files.join(level.select("path", F.lower(F.hex("digest")).alias("tree_sha256")), "path")


def feature_lines(df: DataFrame, key: str, x: Column, y: Column, decimals: int = 6) -> DataFrame:
    """One GeoJSON feature a row as text, with the key as id, sorted properties and rounded coordinates."""
    at = lambda c: F.rint(c * 10**decimals) / 10**decimals
    properties = F.struct(*[F.col(c) for c in sorted(df.columns)])
    feature = F.struct(F.lit("Feature").alias("type"), F.col(key).alias("id"), F.struct(F.lit("Point").alias("type"), F.array(at(x), at(y)).alias("coordinates")).alias("geometry"), properties.alias("properties"))
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def escaped_cells(df: DataFrame) -> DataFrame:
    """Every text cell escaped for spreadsheets."""
    return df.select(*[X.escaped_formula(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def canonical_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """Key columns first, numbers in canonical text, rows in key order."""
    kinds = dict(df.dtypes)
    show = lambda c: X.canonical(c).alias(c) if kinds[c] in ("double", "float") else F.col(c).cast("string").alias(c)
    return df.orderBy(*key).select(*[show(c) for c in [*key, *[c for c in df.columns if c not in key]]])


def asserted(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """A delimited file, every cell as text, whose header has to be these columns in this order; a byte order mark before the first is dropped."""
    first = spark.read.text(path).where(F.length("value") > 0).limit(1).collect()  # the header of one of the files
    found = first[0]["value"].lstrip("\ufeff").replace('"', "").split(sep) if first else columns
    if found != columns:
        raise ValueError(f"header {found} instead of {columns}")
    return spark.read.csv(path, schema=", ".join(f"`{c}` string" for c in columns), sep=sep, header=True, enforceSchema=True, encoding="UTF-8")


def read_estimates(spark: SparkSession, path: str, table: str, lines: list[int], header: list[str], level: str = "1400000US", codes: tuple[str, ...] = ()) -> DataFrame:
    """geoid and the estimate and margin of each wanted line of a pipe-delimited survey table, of rows of one summary level; annotation codes are null."""
    rows = asserted(spark, path, header, "|").where(F.col("GEO_ID").startswith(level))
    named = lambda kind, n: F.col(f"{table}_{kind}{n:03}")
    values = [X.lenient_number(X.codes_to_null(named(kind, n), codes) if codes else named(kind, n)).alias(f"{name}_{n}") for n in lines for kind, name in (("E", "estimate"), ("M", "moe"))]
    return rows.select(F.right("GEO_ID", F.lit(11)).alias("geoid"), *values)


def read_feed(spark: SparkSession, folder: str, required: dict[str, list[str]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables <name>.txt of a feed that are there, and (name, problem) for required files and columns that aren't; coordinates are lenient numbers."""
    found, problems = {}, []
    for name, columns in required.items():
        try:
            df = spark.read.csv(f"{folder}/{name}.txt", header=True, encoding="UTF-8")
        except Exception as error:  # noqa: BLE001  Spark has no other way to say that a path isn't there
            if "PATH_NOT_FOUND" not in str(error):
                raise
            problems.append((name, "file missing"))
            continue
        problems += [(name, f"column missing: {c}") for c in columns if c not in df.columns]
        found[name] = df.select(*[X.lenient_number(c).alias(c) if c.endswith(("_lat", "_lon")) else F.col(c) for c in df.columns])
    return found, spark.createDataFrame(problems, "name string, problem string")


def geojson_shapes(spark: SparkSession, path: str) -> DataFrame:
    """id, properties, type, paths and parts of the line and area features of newline-delimited GeoJSON.

    paths are arrays of points: of the lines of a LineString or MultiLineString, and of the rings of a Polygon; parts are the polygons of a
    Polygon or MultiPolygon. Other features, and features without geometry, have neither.
    """
    schema = "id string, properties map<string, string>, geometry struct<type: string, coordinates: string>"
    f = spark.read.schema(schema).json(path).select("id", "properties", "geometry.*")
    line, lines, areas = (F.from_json("coordinates", "array<" * n + "double" + ">" * n) for n in (2, 3, 4))
    points = lambda path: F.transform(path, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    kind = F.col("type")
    paths = F.when(kind == "LineString", F.array(points(line))).when(kind.isin("Polygon", "MultiLineString"), F.transform(lines, points))
    parts = F.when(kind == "Polygon", F.array(F.transform(lines, points))).when(kind == "MultiPolygon", F.transform(areas, lambda a: F.transform(a, points)))
    return f.select("id", "properties", "type", paths.alias("paths"), parts.alias("parts"))


def shape_lines(df: DataFrame, key: str, shape: str, area: bool, decimals: int = 6, members: dict[str, str] | None = None) -> DataFrame:
    """One GeoJSON feature a row as text: lines (of one or two levels) or areas (of one to three), in Multi types where there are several parts.

    Coordinates are rounded, shells go left about and holes right about, all other columns become sorted properties with their nulls, and
    members (such as a license label) stand at the top of every feature. A null shape gives a null geometry.
    """
    at = lambda c: F.rint(c.cast("double") * 10**decimals) / 10**decimals
    path = lambda points: F.transform(points, lambda p: F.array(at(p["x"]), at(p["y"])))
    turn = lambda ring, i: F.when((G.signed_area(ring) < 0) == (i == 0), F.reverse(ring)).otherwise(ring)
    if area:
        parts = F.transform(shapes.as_parts(df, shape), lambda rings: F.transform(rings, lambda ring, i: path(turn(ring, i))))
        one, many = "Polygon", "MultiPolygon"
    else:
        parts = F.transform(F.array(F.col(shape)) if shapes.nesting(df, shape) == 1 else F.col(shape), path)
        one, many = "LineString", "MultiLineString"
    single = F.size("parts_") == 1
    geometry = F.concat(F.lit('{"type":"'), F.when(single, one).otherwise(many), F.lit('","coordinates":'), F.when(single, F.to_json(F.get("parts_", F.lit(0)))).otherwise(F.to_json("parts_")), F.lit("}"))
    whole = {"ignoreNullFields": "false"}
    properties = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns) if c != shape]), whole)
    top = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in sorted((members or {}).items())], F.lit("Feature").alias("type")), whole)
    id_ = F.regexp_extract(F.to_json(F.struct(F.col(key).alias("id")), whole), r"^\{(.*)\}$", 1)
    text = F.concat(F.expr("left(top_, length(top_) - 1)"), F.lit(","), id_, F.lit(',"geometry":'), F.coalesce(F.when(F.col(shape).isNotNull(), geometry), F.lit("null")), F.lit(',"properties":'), properties, F.lit("}"))
    return df.withColumn("parts_", parts).withColumn("top_", top).select(text.alias("value"))


def read_roads(df: DataFrame, classes: tuple[str, ...], class_column: str, key: str) -> DataFrame:
    """The rows of some classes in the order of their identifier."""
    return df.where(F.col(class_column).isin(*classes)).orderBy(key)


NODES = "node_id bigint, lon double, lat double, tags map<string, string>"
WAYS = "way_id bigint, refs array<bigint>, tags map<string, string>"
RELATIONS = "relation_id bigint, members array<struct<kind: string, ref: bigint, role: string>>, tags map<string, string>"


def read_street(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """nodes, ways (refs in order, tags) and relations (members of any kind with their roles, tags) of a decoded street extract."""
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in (("nodes", NODES), ("ways", WAYS), ("relations", RELATIONS))}


def read_retailers(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Every cell of a retailer table as text, trimmed, blanks null; its header has to be these columns."""
    return trimmed(asserted(spark, path, columns))
