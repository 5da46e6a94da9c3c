"""Editing of JSON text (F2): one key is set and every other key, modelled or not, stays.

The text goes through VARIANT, so it is edited in the JVM without a schema. Keys come out in alphabetical order; text that is no
JSON object, or repeats a key, cannot be edited and is given back as it is (or null where a new object was asked for).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OBJECT = "map<string,variant>"


def _set(obj: Column, key: str, value: Column) -> Column:
    kept = F.map_filter(F.coalesce(obj, F.expr(f"CAST(parse_json('{{}}') AS {_OBJECT})")), lambda k, _: k != key)
    return F.to_variant_object(F.map_concat(kept, F.create_map(F.lit(key), value)))


def _once(value: Column, fn) -> Column:
    """``fn`` of a costly ``value`` that it names more than once: as a lambda's variable it is made once a row."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def set_key(text, path: tuple[str, ...], value: Column) -> Column:
    """The object ``text`` with the text ``value`` under ``path`` (one key, or a key and the key inside it)."""
    text = F.col(text) if isinstance(text, str) else text

    def put(top: Column) -> Column:
        new = value.cast("variant")
        if len(path) == 2:
            new = _set(top[path[0]].try_cast(_OBJECT), path[1], new)
        return F.when(top.isNotNull(), F.to_json(_set(top, path[0], new)))
    return F.coalesce(_once(F.try_parse_json(text).try_cast(_OBJECT), put), text)


def array_of(text, key: str) -> Column:
    """The elements of the array under ``key`` as VARIANT values; null where there is none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.try_variant_get(F.try_parse_json(text), f"$.{key}", "array<variant>")


def with_key(element: Column, key: str, value: Column) -> Column:
    """The text of the object ``element`` (VARIANT) with the text ``value`` under ``key``; null if it is no object."""
    return _once(element.try_cast(_OBJECT), lambda obj: F.when(obj.isNotNull(), F.to_json(_set(obj, key, value.cast("variant")))))


def object_size(text, key: str) -> Column:
    """The number of keys of the object under ``key``; 0 where there is none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.size(F.json_object_keys(F.get_json_object(text, f"$.{key}"))), F.lit(0))
