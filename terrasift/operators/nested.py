"""Deeply nested JSON reports to flat tables with parent-child links, in one higher-order projection.

A report's content may be wrapped (an encoded string, a ``report`` object, JSON lines), grouped
(``groups`` of cases) or plain (an array, an object with ``cases``/``results``/``records``, a single
case). All levels are walked with ``from_json`` to ``array<string>`` / ``map<string,string>``: a map
keeps scalars decoded and leaves objects and arrays as JSON text for the next level, so an object and
its encoded text look alike, which is what the producers' spellings need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the names under which the producers keep a list of cases
LISTS = ("cases", "results", "records")


# fixed values: the byte order mark and the white space of JSON texts and their wrappings
_BLANK = "\ufeff \t\n\x0b\x0c\r"


def _strip(c: Column) -> Column:
    return F.trim(c, F.lit(_BLANK))


def _array(c: Column) -> Column:
    """Elements of a JSON array as JSON text (strings decoded); null for anything else."""
    return F.when(F.startswith(F.ltrim(c), F.lit("[")), F.from_json(c, "array<string>"))


def _map(c: Column) -> Column:
    return F.when(F.startswith(F.ltrim(c), F.lit("{")), F.from_json(c, "map<string,string>"))


def _at(c: Column, key: str) -> Column:
    return F.try_element_at(c, F.lit(key))


def _held(c: Column) -> Column:
    """In brackets, since the parser stops after the first value."""
    return F.concat(F.lit("["), c, F.lit("]"))


def _by_line(c: Column) -> Column:
    """The lines of JSON lines as one array; null if one of them isn't a complete JSON value."""
    lines = F.filter(F.transform(F.split(c, r"\n"), _strip), lambda x: x != "")
    one = lambda x: F.try_parse_json(_held(x)).isNotNull() & (F.json_array_length(_held(x)) == 1)
    return F.when((F.size(lines) > 1) & F.forall(lines, one), _held(F.concat_ws(",", lines)))


def _complete(c: Column) -> Column:
    """The text if it is one complete JSON value, its lines as one array if all of them are; else null."""
    whole = F.try_parse_json(_held(c)).isNotNull() & (F.json_array_length(_held(c)) == 1)
    return F.when(whole, c).otherwise(_by_line(c))


def _unquoted(c: Column) -> Column:
    """The text that an encoded string holds; anything else unchanged."""
    inner = F.get(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>"), F.lit(0))
    return F.when(F.startswith(c, F.lit('"')), _complete(_strip(inner))).otherwise(c)


def _listed(m: Column) -> Column:
    return F.coalesce(*(_array(_at(m, k)) for k in LISTS))


def parsed(df: DataFrame, payload: str) -> DataFrame:
    """Adds ``_cases``: the payload's cases in their order, through all groups, as JSON objects.

    Null for a payload that is null, empty or not complete JSON or JSON lines.
    """
    text = df.withColumn("_root", _strip(F.col(payload)))
    text = text.withColumn("_json", F.try_parse_json(_held(F.col("_root"))))  # parsed once for both questions: is it JSON, is it one value
    at = lambda k: F.try_variant_get("_json", f"$[{k}]", "variant")
    text = text.withColumn("_root", F.when(at(0).isNotNull() & at(1).isNull(), F.col("_root")).otherwise(_by_line(F.col("_root")))).drop("_json")
    text = text.withColumn("_root", _unquoted(F.col("_root")))
    text = text.withColumn("_root", F.when(F.startswith("_root", F.lit("{")), F.coalesce(_strip(_at(_map(F.col("_root")), "report")), F.col("_root"))).otherwise(F.col("_root")))
    text = text.withColumn("_map", _map(F.col("_root")))
    groups = F.transform(_array(_at(F.col("_map"), "groups")), lambda g: F.coalesce(_listed(_map(g)), F.array().cast("array<string>")))
    single = F.when(F.col("_map").isNotNull() & F.exists(F.map_keys("_map"), lambda k: k.rlike(r"^(name|kwargs|config|details|outcome|error|attempts|result|expectation)(\.|$)")), F.array("_root"))
    cases = F.coalesce(_array(F.col("_root")), F.flatten(groups), _listed(F.col("_map")), single)
    # an element may itself be encoded, and JSON lines may hold one list each
    flat = F.flatten(F.transform(cases, lambda c: F.coalesce(_array(c), F.array(c))))
    return text.withColumn("_cases", F.filter(flat, lambda c: F.startswith(F.ltrim(c), F.lit("{")))).drop("_root", "_map")


def nodes(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """One row per payload with ``_nodes``: array of (case_no, attempt_no, m), m the node's fields.

    Attempt 0 is the case itself, attempts count from 1 by their place.
    """

    def of_case(c: Column, i: Column) -> Column:
        m = _map(c)
        own = F.array(F.struct(i.cast("long").alias("case_no"), F.lit(0).cast("long").alias("attempt_no"), m.alias("m")))
        tried = F.coalesce(_array(_at(m, "attempts")), F.array().cast("array<string>"))
        return F.concat(own, F.transform(tried, lambda a, j: F.struct(i.cast("long").alias("case_no"), (j + 1).cast("long").alias("attempt_no"), _map(a).alias("m"))))

    p = parsed(df, payload)
    return p.select(*keys, F.flatten(F.transform("_cases", of_case)).alias("_nodes"))


def _inside(holder: Column, key: str) -> Column:
    """``key`` of an object, of its encoded text, of an array of key/val pairs or of an array of objects."""
    pairs = F.transform(_array(holder), lambda o: _map(o))
    of_pair = F.get(F.filter(F.transform(pairs, lambda o: F.when(_at(o, "key") == key, _at(o, "val"))), lambda v: v.isNotNull()), F.lit(0))
    of_item = F.get(F.filter(F.transform(pairs, lambda o: _at(o, key)), lambda v: v.isNotNull()), F.lit(0))
    return F.coalesce(_at(_map(holder), key), of_pair, of_item)


def _leaf(m: Column, parent: str, wrapper: str, key: str) -> Column:
    """The leaf ``parent.key``, the parent kept plainly, inside ``wrapper``, or as dotted columns."""
    return F.coalesce(_inside(_at(m, parent), key), _inside(_inside(_at(m, wrapper), parent), key), _inside(_at(m, wrapper), f"{parent}.{key}"), _at(m, f"{parent}.{key}"))


def _error(m: Column) -> Column:
    e = _at(m, "error")
    asobj = _map(e)
    return F.coalesce(F.when(asobj.isNotNull(), _at(asobj, "message")).otherwise(e), _at(m, "error.message"))


def leaves(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """Table (keys, case_no, attempt_no, leaf_path, leaf_text) of the three leaves, where not null or empty."""

    def of_node(n: Column) -> Column:
        m = n["m"]
        found = {"kwargs.static_source": _leaf(m, "kwargs", "config", "static_source"), "details.sensor_mode": _leaf(m, "details", "outcome", "sensor_mode"), "error": _error(m)}
        return F.array(*(F.struct(n["case_no"].alias("case_no"), n["attempt_no"].alias("attempt_no"), F.lit(k).alias("leaf_path"), v.alias("leaf_text")) for k, v in found.items()))

    return nodes(df, payload, keys).select(*keys, F.inline(F.flatten(F.transform("_nodes", of_node)))).where("leaf_text is not null and leaf_text <> ''")


def attempts_table(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """Table of cases (attempt_no 0) and attempts with their scalar fields."""

    def of_node(n: Column) -> Column:
        m = n["m"]
        return F.struct(
            n["case_no"].alias("case_no"), n["attempt_no"].alias("attempt_no"), *(_at(m, k).alias(k) for k in ("name", "expectation", "result", "error_type")),
            _leaf(m, "kwargs", "config", "crop").alias("crop"), _leaf(m, "kwargs", "config", "year").alias("crop_year"),
            _leaf(m, "kwargs", "config", "static_source").alias("static_source"), _leaf(m, "details", "outcome", "sensor_mode").alias("sensor_mode"), _error(m).alias("error"),
        )

    return nodes(df, payload, keys).select(*keys, F.inline(F.transform("_nodes", of_node)))


def windows_table(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """Table of ``kwargs.windows``: (keys, case_no, attempt_no, window_no, label, start, end, coverage_pct)."""

    def of_node(n: Column) -> Column:
        ws = _array(_leaf(n["m"], "kwargs", "config", "windows"))

        def of_window(w: Column, k: Column) -> Column:
            m = _map(w)
            return F.struct(
                n["case_no"].alias("case_no"), n["attempt_no"].alias("attempt_no"), k.cast("long").alias("window_no"),
                *(_at(m, x).alias(x) for x in ("label", "start", "end")), _at(_map(_at(m, "score")), "coverage_pct").try_cast("double").alias("coverage_pct"),
            )

        return F.coalesce(F.transform(ws, of_window), F.array())

    return nodes(df, payload, keys).select(*keys, F.inline(F.flatten(F.transform("_nodes", of_node))))
