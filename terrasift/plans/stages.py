"""The stages of a class map, each a function from DataFrames to a DataFrame, usable alone or one after another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import components as C
from ..operators import quality as Q
from ..operators import raster as R
from ..operators import smoothing as N
from ..operators import trees as T
from ..sources.files import RESULT_SCHEMA


def classified(series: DataFrame, model: T.Ensemble, first: str, last: str) -> DataFrame:
    """(keys, cls): index, smoothing over the whole series, inference window, signal test, ensemble.

    ``series`` has dates, red and nir arrays of one length; the model's features are the dates in the window, of
    which there must be as many in every row. Pixels without a signal in the window have no class.
    """
    keys = [c for c in series.columns if c not in ("dates", "red", "nir")]
    v = series.select(*keys, "dates", S.ndvi_array(F.col("red"), F.col("nir")).cast("array<float>").alias("v"))
    z = F.filter(F.arrays_zip("dates", "smooth"), lambda p: p["dates"].between(first, last))
    w = N.smooth(v, "v").select(*keys, F.transform(z, lambda p: p["smooth"]).alias("f"))
    signal = F.exists("f", lambda x: x.isNotNull() & (x != 0))
    return T.predict(w.select(*keys, F.when(signal, F.col("f")).alias("f")), model, "f").drop("f")


def mosaicked(px: DataFrame, order: str) -> DataFrame:
    """One class per cell of overlapping tiles: the first tile with data wins."""
    return R.first_wins(px, ["row", "col"], "cls", order)


def cleaned(px: DataFrame, target: Sequence[int], least: int, conn: int = 4, chip: int = C.CHIP) -> DataFrame:
    """Chips with ``cls`` and ``sieved``: the sieve and its directional revert. A map without data fails the query."""
    data = Q.refuse_empty(px, "cls").first()  # raises
    assert data is not None
    chips = C.sieve_chips(C.to_chips(px, ["cls"], chip), "cls", least, conn, chip)
    return C.revert_chips(chips, "cls", "sieved", target, conn, chip)


def outlined(chips: DataFrame, target: Sequence[int], label: int, lon0: float, lat0: float, step: float, zone: int, least_acres: float = 0.5, chip: int = C.CHIP) -> DataFrame:
    """A result layer (predicted, area_acres, geometry): one polygon per region of a target class, of at least so many acres."""
    comp = C.component_chips(chips, "sieved", 4, chip)
    stats = C.polygon_stats_chips(comp, "sieved", lon0, lat0, step, zone, chip).where(F.col("sieved").isin(*target) & (F.col("acres") >= least_acres))
    shapes = C.polygonise_chips(comp, "sieved", lon0, lat0, step, chip)
    out = shapes.join(stats.select("comp", "acres"), "comp").select(F.lit(label).cast("long").alias("predicted"), F.col("acres").alias("area_acres"), F.col("wkb").alias("geometry"))
    assert out.schema.simpleString() == out.sparkSession.createDataFrame([], RESULT_SCHEMA).schema.simpleString()
    return out


def assessed(layer: DataFrame, chips: DataFrame, static: DataFrame, target: Sequence[int], chip: int = C.CHIP) -> DataFrame:
    """One row: polygons, acres, pixels of the target before and after the second map, retention and its warning."""
    px = C.from_chips(chips, ["sieved"], chip).join(static.select("row", "col", F.col("cls").alias("second")), ["row", "col"], "left")
    px = px.withColumn("second", F.when(F.col("sieved").isin(*target), F.col("second"))).withColumn("g", F.lit(1))
    kept = Q.warnings(Q.retention(px, "g", "sieved", "second", list(target)), "retention_pct")
    area = layer.groupBy().agg(F.count(F.lit(1)).alias("n_polygons"), F.coalesce(F.sum("area_acres"), F.lit(0.0)).alias("acres")).withColumn("g", F.lit(1))
    return area.join(kept, "g").drop("g")
