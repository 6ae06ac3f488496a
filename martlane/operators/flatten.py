"""Rows and typed columns out of VARIANT payloads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def path(value: Column | str, json_path: str, type_name: str, strict: bool = True) -> Column:
    """Value at a path; missing paths and JSON null give NULL.

    ``strict`` raises on a value that does not fit the type, otherwise it
    becomes NULL.
    """
    get = F.variant_get if strict else F.try_variant_get
    return get(value, json_path, type_name)


def object_size(value: Column | str, json_path: str) -> Column:
    """Number of keys of the object at a path; NULL when there is none."""
    members = F.try_variant_get(value, json_path, "map<string,variant>")
    return F.when(members.isNotNull(), F.size(members))


def flatten(
    df: DataFrame,
    array_path: str,
    fields: Mapping[str, tuple[str, str]],
    raw: str = "RAW",
    strict: bool = True,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per array element with ``fields`` (output -> path, type).

    Empty and missing arrays and values that are no array give no rows. The
    element is exploded first and read once into typed columns, so nothing
    downstream carries the payload. Works on batch and streaming frames.
    ``extra`` adds computed columns over the element, named ``item``.
    """
    items = df.select(F.explode(F.try_variant_get(raw, array_path, "array<variant>")).alias("item"))
    columns = [path("item", p, t, strict).alias(name) for name, (p, t) in fields.items()]
    columns += [column.alias(name) for name, column in (extra or {}).items()]
    return items.select(*columns)


def misfits(
    df: DataFrame, array_path: str, fields: Mapping[str, tuple[str, str]], raw: str = "RAW"
) -> DataFrame:
    """The array elements that a lenient ``flatten`` loses a value of: ``payload``, ``fields``.

    These are elements with a value at some path that is there, is not JSON null and
    does not fit the path's type; ``payload`` is the element's text and ``fields``
    names the outputs concerned. Works on batch and streaming frames.
    """
    items = df.select(F.explode(F.try_variant_get(raw, array_path, "array<variant>")).alias("item"))

    def unfit(json_path: str, type_name: str) -> Column:
        value = F.try_variant_get("item", json_path, "variant")
        there = value.isNotNull() & ~F.is_variant_null(value)
        return there & F.try_variant_get("item", json_path, type_name).isNull()

    names = F.array_compact(
        F.array(*[F.when(unfit(p, t), F.lit(name)) for name, (p, t) in fields.items()])
    )
    found = items.select(F.to_json("item").alias("payload"), names.alias("fields"))
    return found.filter(F.size("fields") > 0)
