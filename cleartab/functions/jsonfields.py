"""Reading fields out of raw JSON text whose shape cannot be trusted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleartab.functions.text import full_match, try_integer

def json_text(col: Column, key: str) -> Column:
    return F.get_json_object(col, f"$.{key}")


def json_integer(col: Column, key: str) -> Column:
    """A number that may arrive as text or with decimals; anything else is null."""
    return try_integer(json_text(col, key))


def unquote(col: Column) -> Column:
    """A JSON scalar without its quotes."""
    return F.trim(col, F.lit('"'))


_MAPS = "array<map<string,string>>"
_SCALAR = 'null|true|false|-?[0-9][0-9.eE+-]*|".*"'


_FLAT = r'(?s)\[\s*+(?:\{(?:[^"{}\[\]]++|"(?:[^"\\]++|\\.)*+")*+\}[\s,]*+)*+\]\s*+'
"""An array of objects that hold scalars only. Strings are passed over whole, so brackets in them count for nothing."""
_MARKS = r'(?s)\\.|["\[\]{}]'
"""What moves the automaton: an escape with the character it escapes, a quote, a bracket."""


def _depth(text: Column) -> Column:
    """How deep brackets are nested, by an automaton over the marks of the text.

    Its state is whether a string is open, and the depth now and at most. A quote
    opens or closes a string, an escaped character never does; brackets count
    outside strings only.
    """
    start = F.struct(F.lit(False).alias("quoted"), F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(s: Column, mark: Column) -> Column:
        now = s["now"] + F.when(s["quoted"], 0).when(mark.isin("[", "{"), 1).when(mark.isin("]", "}"), -1).otherwise(0)
        return F.struct((s["quoted"] != (mark == '"')).alias("quoted"), now.alias("now"), F.greatest(s["most"], now).alias("most"))

    return F.reduce(F.regexp_extract_all(text, F.lit(_MARKS), F.lit(0)), start, step, lambda s: s["most"])


def _typed(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _inner(values: Column) -> Column:
    """What the arrays and objects among the values hold, one level down."""
    none = F.array().cast("array<variant>")
    return F.flatten(F.transform(values, lambda v: F.coalesce(
        _typed(v, "array<variant>"), F.map_values(_typed(v, "map<string,variant>")), none)))


def _as_maps(values: Column) -> Column:
    return F.filter(F.transform(values, lambda v: _typed(v, "map<string,string>")), lambda m: m.isNotNull())


def json_objects(col: Column) -> Column:
    """All objects of a JSON value, however deep, as maps of texts: outer objects
    first, then level by level through arrays and objects. A bare object counts
    as an array of one, any other scalar as none; text that is no JSON gives null.

    A flat array of objects, by far the usual case, is parsed in one go. Only
    values that may hold more are parsed into variants, once, and walked as many
    levels as their brackets nest.
    """
    text = F.trim(col)
    array = F.when(text.startswith("["), text).when(
        text.startswith("{"), F.concat(F.lit("["), text, F.lit("]")))
    start = F.struct(F.from_json(array, "array<variant>").alias("level"), F.array().cast(_MAPS).alias("found"))
    walked = F.reduce(
        F.sequence(F.lit(1), F.greatest(_depth(array), F.lit(1))), start,
        lambda s, _: F.struct(_inner(s["level"]).alias("level"),
                              F.concat(s["found"], _as_maps(s["level"])).alias("found")),
        lambda s: s["found"])
    scalar = F.when(full_match(text, _SCALAR), F.array().cast(_MAPS))
    return F.coalesce(F.when(full_match(array, _FLAT), F.from_json(array, _MAPS)), walked, scalar)


def values_of(objects: Column, key: str) -> Column:
    """The texts under a key, from the objects that have it (a JSON null counts)."""
    holders = F.filter(objects, lambda m: F.coalesce(F.map_contains_key(m, key), F.lit(False)))
    return F.transform(holders, lambda m: F.try_element_at(m, F.lit(key)))


def integers_of(objects: Column, key: str) -> Column:
    """The same values as whole numbers, null where they are none."""
    return F.transform(values_of(objects, key), lambda x: try_integer(x, "int"))


def json_values(col: Column, key: str) -> Column:
    return values_of(json_objects(col), key)


def json_integers(col: Column, key: str) -> Column:
    return integers_of(json_objects(col), key)
