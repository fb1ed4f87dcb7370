"""JSON records as ``map<string,string>`` with key-presence fallbacks.

A landed JSON object is parsed once into ``map<string,string>``: scalar values
arrive as their text, nested arrays/objects as their JSON text, an explicit
``null`` as a NULL value.  Anything that is not an object (a string, ``null``,
a number, broken JSON) parses to NULL, which is the object-only predicate (F7).

Fallback semantics follow ``raw.get(a, raw.get(b, default))``: the next key is
consulted only when the previous one is *absent*; an explicit ``null`` stops
the chain and yields NULL.  ``coalesce`` would be wrong here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT_SCHEMA = "map<string,string>"


def parse_object(json_text: Column) -> Column:
    """JSON text -> ``map<string,string>``; NULL when it is not an object."""
    return F.from_json(json_text, OBJECT_SCHEMA)


def is_object(parsed: Column) -> Column:
    """the item is a JSON object."""
    return parsed.isNotNull()


def get_first(m: Column, *keys: str, default=None) -> Column:
    """Value of the first *present* key of ``keys``, else ``default``.

    ``default`` may be a Python literal or a Column.
    """
    out = default if isinstance(default, Column) else F.lit(default)
    for k in reversed(keys):
        out = F.when(F.map_contains_key(m, F.lit(k)), m[k]).otherwise(out)
    return out


def get_str(m: Column, *keys: str) -> Column:
    """String field with the reference default ``""`` for an absent key."""
    return get_first(m, *keys, default="").cast("string")


def get_str_array(m: Column, key: str) -> Column:
    """A list-of-strings field (nested JSON array text) with default ``[]``."""
    present = F.from_json(m[key], "array<string>")
    return F.when(F.map_contains_key(m, F.lit(key)), present).otherwise(
        F.array().cast("array<string>"))
