"""Tolerant framing, strict content: fields of a model's JSON reply, as column functions on variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_reply(raw: Column) -> Column:
    """The reply's JSON object: as it stands, inside a code fence, or from the first brace to the last; null if there is none."""

    def obj(text: Column) -> Column:
        v = F.try_parse_json(text)
        return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)

    fence = F.regexp_extract(raw, r"(?s)```(?:json|JSON)?\s*(.*?)```", 1)
    braces = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    return F.coalesce(obj(raw), obj(F.nullif(fence, F.lit(""))), obj(F.nullif(braces, F.lit(""))))


def _field(reply: Column, key: str) -> tuple[Column, Column]:
    v = F.try_variant_get(reply, f"$.{key}", "variant")
    return v, F.schema_of_variant(v)


def _absent(v: Column, kind: Column) -> Column:
    """Missing, or null."""
    return v.isNull() | (kind == "VOID")


def require_bool(reply: Column, key: str) -> Column:
    """Exactly true or false, else null (an error)."""
    v, kind = _field(reply, key)
    return F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))


def require_choice(reply: Column, key: str, choices: tuple[str, ...]) -> Column:
    """One of the choices, else null (an error)."""
    v, kind = _field(reply, key)
    text = F.trim(F.try_variant_get(v, "$", "string"))
    return F.when((kind == "STRING") & text.isin(*choices), text)


def optional_str(reply: Column, key: str, size: int = 500) -> Column:
    """struct<value, error>: trimmed and cut to size, null if missing or blank; ``wrong_type`` if it is there and no string."""
    v, kind = _field(reply, key)
    text = F.when(kind == "STRING", F.nullif(F.left(F.trim(F.try_variant_get(v, "$", "string")), F.lit(size)), F.lit("")))
    return F.struct(text.alias("value"), F.when(~_absent(v, kind) & (kind != "STRING"), "wrong_type").alias("error"))


def optional_float(reply: Column, key: str, low: float = 0.0, high: float = 1.0) -> Column:
    """struct<value, error>: a number, null if missing; ``wrong_type`` or ``out_of_range`` (nothing is clamped) if it is there and none from low to high."""
    v, kind = _field(reply, key)
    x = F.try_variant_get(v, "$", "double")
    number = (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    inside = F.coalesce(x.between(low, high), F.lit(False))
    return F.struct(F.when(number & inside, x).alias("value"), F.when(_absent(v, kind), None).when(~number, "wrong_type").when(~inside, "out_of_range").alias("error"))


def whole_number(reply: Column, key: str) -> Column:
    """A whole number of 0 or more; null if missing or anything else."""
    v, kind = _field(reply, key)
    n = F.try_variant_get(v, "$", "long")
    return F.when((kind == "BIGINT") & (n >= 0), n)
