"""Typed extraction from semi-structured documents.

Documents become a VARIANT column once (``parse_json``), then every field is a
``variant_get`` on that column, so each document is parsed a single time per row and
the extraction stays a JVM expression. Semantics match a warehouse ``v:path::TYPE``:
JSON null and a missing path are NULL, a numeric string casts to its number, a fraction
cast to a whole number rounds half away from zero (1.5 -> 2, as the warehouse casts),
and an uncastable value fails the query unless ``on_error="null"``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

# Types understood by ``extract``: name -> (variant_get target type, cast after).
# Timestamps go through the zoned type and then to wall-clock UTC, so an offset such
# as ``Z`` or ``+02:00`` in the text is honoured rather than dropped.
_TYPES = {
    "string": ("string", None),
    "bigint": ("decimal(38,9)", "round_bigint"),
    "int": ("decimal(38,9)", "round_bigint"),
    "double": ("double", None),
    "boolean": ("boolean", None),
    "timestamp": ("timestamp", "timestamp_ntz"),
    "date": ("date", None),
    "variant": ("variant", None),
}


def to_variant(df: DataFrame, col: str, out: str | None = None, strict: bool = False) -> DataFrame:
    """Parse a JSON text column into VARIANT (``try_parse_json`` unless ``strict``)."""
    if isinstance(df.schema[col].dataType, VariantType):
        return df if out in (None, col) else df.withColumn(out, F.col(col))
    fn = F.parse_json if strict else F.try_parse_json
    return df.withColumn(out or col, fn(F.col(col)))


def _path(p: str) -> str:
    return p if p.startswith("$") else "$." + p


def variant_field(v: Column, path: str, typ: str, on_error: str = "fail") -> Column:
    target, after = _TYPES[typ]
    getter = F.try_variant_get if on_error == "null" else F.variant_get
    c = getter(v, _path(path), target)
    if after == "round_bigint":
        # whole numbers pass unchanged; fractions round half away from zero
        r = F.round(c, 0)
        return r.try_cast("bigint") if on_error == "null" else r.cast("bigint")
    return c.cast(after) if after else c


#: Paths of names alone: their first name is a field of the document.
_NAMES = re.compile(r"(?:\$\.)?([A-Za-z_]\w*)((?:\.[A-Za-z_]\w*)*)", re.ASCII)


def extract(df: DataFrame, col: str, fields: Mapping[str, tuple[str, str]],
            keep: Iterable[str] = (), on_error: str = "fail", one_walk: bool = False) -> DataFrame:
    """Select ``keep`` columns plus one typed column per ``name: (path, type)``.

    ``col`` may be JSON text or VARIANT. Paths are ``a.b`` or ``$.a.b``. A lookup by path compares the names of a document
    one by one; ``one_walk`` takes all its fields in one pass instead, for callers that read every one of ``fields``
    (those that a caller drops are taken as well then).
    """
    tmp, parts = "__doc_v", "__doc_f"
    d = to_variant(df, col, tmp)
    split = {n: _NAMES.fullmatch(p) for n, (p, _) in fields.items()} if one_walk else {}
    heads = list(dict.fromkeys(m[1] for m in split.values() if m))
    if len({h.lower() for h in heads}) < len(heads):            # names that differ in case alone can't be told apart
        heads = []
    if heads:
        d = d.withColumn(parts, F.try_variant_get(F.col(tmp), "$", f"struct<{','.join(f'`{h}`:variant' for h in heads)}>"))

    def field(name: str, path: str, typ: str) -> Column:
        m = split.get(name)
        if not heads or not m:
            return variant_field(F.col(tmp), path, typ, on_error)
        return variant_field(F.col(parts)[m[1]], f"${m[2]}", typ, on_error)

    cols = [F.col(k) for k in keep]
    cols += [field(n, p, t).alias(n) for n, (p, t) in fields.items()]
    return d.select(*cols)


def coalesce_key(inner: str | Column, outer: str | Column) -> Column:
    """Key from inside the document, else the landing column."""
    i = F.col(inner) if isinstance(inner, str) else inner
    o = F.col(outer) if isinstance(outer, str) else outer
    return F.coalesce(i, o)


def fill_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Default 0 for count columns (P5), keeping each column's type."""
    cols = list(cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})
