"""Column functions of the raster domain: band arithmetic, bit masks, names, dates, projections."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: constants that define results
ACRES_PER_M2 = 0.000247105
M2_PER_ACRE = 4046.8564224
SCENE_CLOUD_LIMIT = 80
SCL_MASKED = (3, 8, 9, 10)
QA_BITS = (3, 4)
NODATA_CLASS = 255


def ndvi(red: Column, nir: Column) -> Column:
    """(nir - red) / (nir + red), null where the sum is not positive or a band is null."""
    return F.when(nir + red > 0, (nir - red) / (nir + red))


def ndvi_array(red: Column, nir: Column) -> Column:
    return F.zip_with(red, nir, ndvi)


def scaled_ndvi(v: Column) -> Column:
    """NDVI x 10000 in 0..65535; negatives become 0."""
    return F.greatest(F.lit(0), F.least(F.lit(65535), F.floor(v * 10000).cast("int")))


def landsat_scaled(dn: Column) -> Column:
    """Collection-2 surface reflectance to the x10000 scale, floored at 0."""
    return F.greatest(F.lit(0), F.least(F.lit(65535), F.floor((dn * 0.0000275 - 0.2) * 10000).cast("int")))


def _scaled(dn: Column) -> Column:
    return (dn * 0.0000275 - 0.2) * 10000


def _band(v: Column) -> Column:
    """A 16-bit band: floored at 0 after everything else."""
    return F.greatest(F.lit(0), F.least(F.lit(65535), F.floor(v).cast("int")))


def red_edge(red: Column, nir: Column) -> Column:
    """The band that the sensor lacks, from the raw values of its neighbours: their mean, floored afterwards."""
    return _band((_scaled(red) + _scaled(nir)) / 2)


def harmonised(blue: Column, green: Column, red: Column, nir: Column) -> Column:
    """The six bands of the other sensor from four raw ones; the index is null where the sum of its bands isn't positive."""
    r, n = _scaled(red), _scaled(nir)
    index = F.when(r + n > 0, _band((n - r) / (r + n) * 10000))
    return F.struct(landsat_scaled(blue).alias("blue"), landsat_scaled(green).alias("green"), landsat_scaled(red).alias("red"), red_edge(red, nir).alias("red_edge"), landsat_scaled(nir).alias("nir"), index.alias("ndvi"))


def clear_scl(scl: Column) -> Column:
    return ~scl.isin(*SCL_MASKED)


def clear_qa(qa: Column) -> Column:
    mask = sum(1 << b for b in QA_BITS)
    return qa.bitwiseAND(F.lit(mask)) == 0


def penalty(day: Column, anchor: Column, cloud: Column) -> Column:
    """Days from the anchor plus a fifth of the cloud percentage."""
    return F.abs(F.datediff(day, anchor)) + cloud / 5


def band_kind(description: Column) -> Column:
    """red or nir from a band description, else null."""
    head = F.regexp_extract(description, r"^(red|B4|nir|B8)_(\d{4})_(\d{2})_(\d{2})$", 1)
    return F.when(head.isin("red", "B4"), "red").when(head.isin("nir", "B8"), "nir")


def band_date(description: Column) -> Column:
    """The date of a band description; null if there is none or it is no date."""
    d = F.regexp_extract(description, r"^(?:red|B4|nir|B8)_(\d{4}_\d{2}_\d{2})$", 1)
    return F.try_to_timestamp(F.when(d != "", d), F.lit("yyyy_MM_dd")).cast("date")


def flat_index(row: Column, col: Column, width: Column | int, valid: Column) -> Column:
    """row * width + col in 64 bits for valid pixels, else -1."""
    return F.when(valid, row.cast("long") * width + col).otherwise(F.lit(-1).cast("long"))


def gap_mask(series: Column) -> Column:
    """Bit t is set where value t is present; a series of more than 63 values fails the query, see ``gap_pattern``."""
    bits = F.transform(series, lambda v, t: F.when(v.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("long"), t)).otherwise(F.lit(0).cast("long")))
    short = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a + b)
    return F.when(F.size(series) <= 63, short).otherwise(F.raise_error(F.lit("a mask of bits holds 63 values")).cast("long"))


def gap_pattern(series: Column) -> Column:
    """1 where a value is present, 0 where not, as text of any length."""
    return F.array_join(F.transform(series, lambda v: F.when(v.isNotNull(), "1").otherwise("0")), "")


def date_suffix(dates: Column) -> Column:
    """dd_Mon_YYYY of each date, joined by _and_."""
    return F.array_join(F.transform(dates, lambda d: F.date_format(d, "dd_MMM_yyyy")), "_and_")


def filled(template: Column, values: dict[str, Column]) -> Column:
    """A template with its {placeholders} replaced; unknown ones stay."""
    for name, v in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(v.cast("string"), F.lit("")))
    return template


def clean_path(path: Column) -> Column:
    """A pasted path without surrounding blanks, a raw-string prefix and quotes."""
    return F.regexp_replace(F.trim(path), r"""^[rR]?(["'])(.*)\1$""", "$2")


# fixed values: control characters that a pasted backslash path turns into, and the letters they come from
EATEN = {"\x07": "a", "\x08": "b", "\t": "t", "\n": "n", "\x0b": "v", "\x0c": "f", "\r": "r", "\x00": "0"}


def unescaped_path(path: Column) -> Column:
    """A path whose backslashes were read as escapes, with the backslashes put back."""
    for char, letter in EATEN.items():
        path = F.replace(path, F.lit(char), F.lit("\\" + letter))
    return path


def path_spellings(path: Column) -> Column:
    """The path as given, then what else it may be called: a Windows path its WSL and Git-Bash forms, a mounted drive its Windows form."""
    win, mount = r"^([A-Za-z]):[\\/](.*)$", r"^/(?:mnt/)?([A-Za-z])/(.*)$"
    drive = F.lower(F.regexp_extract(path, win, 1))
    rest = F.translate(F.regexp_extract(path, win, 2), "\\", "/")
    back = F.concat(F.upper(F.regexp_extract(path, mount, 1)), F.lit(":\\"), F.translate(F.regexp_extract(path, mount, 2), "/", "\\"))
    posix = F.array(path, F.concat(F.lit("/mnt/"), drive, F.lit("/"), rest), F.concat(F.lit("/"), drive, F.lit("/"), rest))
    return F.array_distinct(F.when(path.rlike(win), posix).when(path.rlike(mount), F.array(path, back)).otherwise(F.array(path)))


def bucket_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^[a-z0-9]+://([^/]+)/?(.*)$", 1)


def blob_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^[a-z0-9]+://([^/]+)/?(.*)$", 2)


def is_shard(name: Column, base: Column) -> Column:
    """Is the name ``base.tif`` or one of its numbered shards."""
    tail = F.substring(name, F.length(base) + 1, F.length(name))
    return F.startswith(name, base) & tail.rlike(r"^(?:\d{10}-\d{10})?\.tif$")


def utm_zone(lon: Column) -> Column:
    return F.floor((lon + 180) / 6).cast("int") + 1


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)


def tile_count(x0: Column, y0: Column, x1: Column, y1: Column, deg: float) -> Column:
    return (F.ceil((x1 - x0) / deg) * F.ceil((y1 - y0) / deg)).cast("long")


# Transverse Mercator on WGS 84 by the published Snyder series, as plain column arithmetic
_A, _E2, _K0 = 6378137.0, 0.0066943799901413165, 0.9996
_M = (1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256, 3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024, 15 * _E2**2 / 256 + 45 * _E2**3 / 1024, 35 * _E2**3 / 3072)


def utm_xy(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing in metres in one zone (north)."""
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s, c, t = F.sin(phi), F.cos(phi), F.pow(F.tan(phi), F.lit(2))
    ep = _E2 / (1 - _E2)
    n = F.lit(_A) / F.sqrt(1 - _E2 * s * s)
    cc, a = ep * c * c, lam * c
    m = _A * (_M[0] * phi - _M[1] * F.sin(2 * phi) + _M[2] * F.sin(4 * phi) - _M[3] * F.sin(6 * phi))
    x = 500000 + _K0 * n * (a + (1 - t + cc) * F.pow(a, F.lit(3)) / 6 + (5 - 18 * t + t * t + 72 * cc - 58 * ep) * F.pow(a, F.lit(5)) / 120)
    y = _K0 * (m + n * F.tan(phi) * (a * a / 2 + (5 - t + 9 * cc + 4 * cc * cc) * F.pow(a, F.lit(4)) / 24 + (61 - 58 * t + t * t + 600 * cc - 330 * ep) * F.pow(a, F.lit(6)) / 720))
    return x, y


def utm_xy_float(lon: float, lat: float, zone: int) -> tuple[float, float]:
    """The same for numbers or arrays on the Python side."""
    import numpy as np

    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (zone * 6 - 183))
    s, c, t = np.sin(phi), np.cos(phi), np.tan(phi) ** 2
    ep = _E2 / (1 - _E2)
    n = _A / np.sqrt(1 - _E2 * s * s)
    cc, a = ep * c * c, lam * c
    m = _A * (_M[0] * phi - _M[1] * np.sin(2 * phi) + _M[2] * np.sin(4 * phi) - _M[3] * np.sin(6 * phi))
    x = 500000 + _K0 * n * (a + (1 - t + cc) * a**3 / 6 + (5 - 18 * t + t * t + 72 * cc - 58 * ep) * a**5 / 120)
    y = _K0 * (m + n * np.tan(phi) * (a * a / 2 + (5 - t + 9 * cc + 4 * cc * cc) * a**4 / 24 + (61 - 58 * t + t * t + 600 * cc - 330 * ep) * a**6 / 720))
    return x, y


def month_day(year: Column, mmdd: Column) -> Column:
    """The date of a MM-DD in a year; a day past the month's end becomes its last day."""
    first = F.make_date(year, F.substring(mmdd, 1, 2).cast("int"), F.lit(1))
    return F.least(F.date_add(first, F.substring(mmdd, 4, 2).cast("int") - 1), F.last_day(first))


def shoelace(xs: Column, ys: Column) -> Column:
    """Signed area of a closed ring given as coordinate arrays."""
    n = F.size(xs)
    idx = F.sequence(F.lit(0), n - 2)
    return F.when(n < 4, 0.0).otherwise(F.aggregate(idx, F.lit(0.0), lambda acc, i: acc + (F.get(xs, i) * F.get(ys, i + 1) - F.get(xs, i + 1) * F.get(ys, i)), lambda acc: acc / 2))


def side_for_acres(acres: float) -> float:
    return math.sqrt(acres * M2_PER_ACRE)
