"""File sources and sinks: outlines, models, job lists, run folders, shards, reports."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import is_shard

RESULT_SCHEMA = "predicted long, area_acres double, geometry binary"
_RING = "array<array<double>>"


def geojson_rings(spark: SparkSession, path: str) -> DataFrame:
    """(poly, ring, seq, x, y) of the polygons and multipolygons of GeoJSON files; points and lines are dropped.

    Takes a FeatureCollection, a feature or a bare geometry; files without a polygon give no rows.
    """
    text = spark.read.text(path, wholetext=True)
    m = lambda c: F.from_json(c, "map<string,string>")
    doc = m("value")
    many = F.coalesce(F.from_json(doc["features"], "array<string>"), F.array("value"))
    geo = text.select(F.input_file_name().alias("_f"), F.posexplode(many).alias("_i", "_t")).select("_f", "_i", m("_t").alias("_m"))
    geo = geo.select("_f", "_i", F.coalesce(m(F.col("_m")["geometry"]), F.col("_m")).alias("g")).select("_f", "_i", F.col("g")["type"].alias("kind"), F.col("g")["coordinates"].alias("c"))
    parts = F.when(F.col("kind") == "Polygon", F.array(F.from_json("c", f"array<{_RING}>"))).when(F.col("kind") == "MultiPolygon", F.from_json("c", f"array<array<{_RING}>>"))
    p = geo.select("_f", "_i", F.posexplode(parts).alias("_p", "rings")).select(F.xxhash64("_f", "_i", "_p").alias("poly"), F.posexplode("rings").alias("ring", "pts"))
    return p.select("poly", "ring", F.posexplode("pts").alias("seq", "q")).select("poly", "ring", "seq", F.get("q", F.lit(0)).alias("x"), F.get("q", F.lit(1)).alias("y"))


def wkb_table(spark: SparkSession, path: str) -> DataFrame:
    """A result layer (predicted, area_acres, geometry as WKB) from Parquet."""
    return spark.read.schema(RESULT_SCHEMA).parquet(path)


def wkb_rings(layer: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """(poly, ring, seq, x, y) of the polygons and multipolygons of a layer with WKB; other kinds and nulls are dropped."""
    from ..operators.components import wkb_rings as read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if w is None or int.from_bytes(w[1:5], "little" if w[0] else "big") not in (3, 6):
                    continue
                for r, q in enumerate(read(w)):
                    n = len(q)
                    yield pa.RecordBatch.from_arrays([pa.array([k] * n, b.schema.field(0).type), pa.array([r] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(q[:, 0]), pa.array(q[:, 1])], names=["poly", "ring", "seq", "x", "y"])

    return layer.select(F.col(key).alias("poly"), geometry).mapInArrow(run, f"poly {layer.schema[key].dataType.simpleString()}, ring long, seq long, x double, y double")


def areas(spark: SparkSession, path: str) -> DataFrame:
    """Rings of an area of interest from GeoJSON or Parquet with WKB; an area without a polygon is an error."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("geojson", "json"):
        rings = geojson_rings(spark, path)
    elif kind == "parquet":
        rings = wkb_rings(spark.read.parquet(path).withColumn("_k", F.monotonically_increasing_id()), "_k")
    else:
        raise NotImplementedError(f"{path}: only GeoJSON and Parquet with WKB are read; convert other formats first")
    if rings.isEmpty():
        raise ValueError(f"{path} has no polygon")
    return rings


def write_chips(chips: DataFrame, path: str, band: int = 64) -> None:
    """Chips as Parquet, in folders of ``band`` rows of chips, so that readers open only those they need."""
    chips.withColumn("chip_band", F.floor(F.col("chip_r") / band).cast("long")).write.mode("overwrite").partitionBy("chip_band").parquet(path)


def read_chips(spark: SparkSession, path: str, rows: tuple[int, int] | None = None, band: int = 64) -> DataFrame:
    """Chips written so; ``rows``: first and last row of chips wanted, which prunes folders and row groups."""
    c = spark.read.parquet(path)
    if rows:
        c = c.where(F.col("chip_band").between(rows[0] // band, rows[1] // band) & F.col("chip_r").between(*rows))
    return c.drop("chip_band")


def same_sources(spark: SparkSession, manifest: str, paths: str) -> bool:
    """Is a stored manifest of fingerprints still that of its sources? Without a manifest it isn't."""
    try:
        old = spark.read.parquet(manifest)
        return old.exceptAll(now := fingerprints(spark, paths)).isEmpty() and now.exceptAll(old).isEmpty()
    except AnalysisException:
        return False


def write_manifest(spark: SparkSession, manifest: str, paths: str) -> None:
    fingerprints(spark, paths).write.mode("overwrite").parquet(manifest)


def write_layer(df: DataFrame, path: str) -> None:
    """Writes a result layer with its full schema, also when it has no rows."""
    df.select(F.col("predicted").cast("long"), F.col("area_acres").cast("double"), F.col("geometry").cast("binary")).write.mode("overwrite").parquet(path)


def empty_layer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT_SCHEMA)


def union_layers(*layers: DataFrame) -> DataFrame:
    """Layers one after another; a column that one of them lacks is null there."""
    out = layers[0]
    for x in layers[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out


def write_report(df: DataFrame, path: str) -> None:
    """Appends records as JSON lines."""
    df.write.mode("append").json(path)


def write_results(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def job_list(spark: SparkSession, path: str) -> DataFrame:
    """Jobs of a JSON list; a job without crop, year or district_name fails the query."""
    j = spark.read.json(path, multiLine=True)
    for c in ("crop", "year", "district_name"):
        if c not in j.columns:
            raise ValueError(f"jobs need {c}")
        j = j.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a job has no {c}")).cast(j.schema[c].dataType)).otherwise(F.col(c)))
    return j


def run_ids(paths: DataFrame, path: str, stage: str) -> DataFrame:
    """(run_id, tag) of the folders named <stage>_run_<n>[_<tag>]."""
    name = F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
    n = F.regexp_extract(name, rf"^{stage}_run_(\d+)(_.*)?$", 1)
    return paths.where(n != "").select(n.cast("int").alias("run_id"), F.nullif(F.regexp_extract(name, rf"^{stage}_run_(\d+)(_.*)?$", 2), F.lit("")).alias("tag"))


def shards(listing: DataFrame, name: str, base: Column) -> DataFrame:
    """The listed names that are the export ``base`` or a shard of it."""
    return listing.where(is_shard(F.col(name), base))


def missing_exports(wanted: DataFrame, listing: DataFrame, key: str, name: str) -> DataFrame:
    """Keys without a plain or sharded export: an anti-join on the name with its shard numbers cut off."""
    base = listing.select(F.regexp_extract(name, r"^(.*?)(?:\d{10}-\d{10})?\.tif$", 1).alias(key)).where(F.col(key) != "").distinct()
    return wanted.join(base, key, "left_anti")


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files, to tell whether a result is still that of its sources."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def model_card(spark: SparkSession, path: str) -> DataFrame:
    """(dates) of a model card: its feature dates, else its training dates; a damaged card has none."""
    t = spark.read.text(path, wholetext=True).select(F.from_json("value", "feature_dates array<string>, training_dates array<string>").alias("c"))
    return t.select(F.coalesce("c.feature_dates", "c.training_dates").alias("dates"))


def tree_model(path: str, kind: str = "nodes", classes: list[int] | None = None):
    """A fitted ensemble from JSON. ``nodes``: (rule, nodes) of the native form {"rule": ..., "nodes": [[tree, node, feature,
    threshold, left, right, leaf], ...]}; ``boosted``: a gradient-boosted classifier's public model file; ``forest``: a
    forest export with class weights per node."""
    from ..operators import trees

    text = Path(path).read_text()
    if kind == "nodes":
        m = json.loads(text)
        return m["rule"], [trees.Node(*n) for n in m["nodes"]]
    return trees.boosted_model(text, classes) if kind == "boosted" else trees.forest_model(text)
