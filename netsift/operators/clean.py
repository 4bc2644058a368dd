"""Cleaning operators: typed casts, null handling, JSON decode/encode.

Each operator is one projection or one filter so Catalyst collapses a whole
cleaning chain into a single codegen stage next to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_ROLES, Roles
from ..functions.casts import bool_to_double, to_double, wire_bool, wire_number


def cast_columns(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Numeric and port columns → double; boolean columns → 1.0 / 0.0 (null → 0.0)."""
    present = set(df.columns)
    exprs: dict[str, Column] = {c: to_double(c) for c in roles.numeric + roles.port if c in present}
    exprs.update({c: bool_to_double(c) for c in roles.boolean if c in present})
    return df.withColumns(exprs) if exprs else df


def wire_coerce(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Text from the wire: numbers default to 0.0, booleans to false."""
    present = set(df.columns)
    exprs: dict[str, Column] = {c: wire_number(c) for c in roles.numeric + roles.port if c in present}
    exprs.update({c: wire_bool(c) for c in roles.boolean if c in present})
    return df.withColumns(exprs) if exprs else df


def drop_null_subset(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows with null (or NaN) in any of ``subset``; a missing column raises."""
    subset = list(subset)
    missing = [c for c in subset if c not in df.columns]
    if missing:
        raise ValueError(f"dropna subset column(s) {missing} not in {df.columns}")
    return df.filter(_complete(df, subset))


def drop_null_any(df: DataFrame) -> DataFrame:
    """Drop rows with null (or NaN) in any column."""
    return df.filter(_complete(df, df.columns))


def _complete(df: DataFrame, cols: Sequence[str]) -> Column:
    """One test per column, which Catalyst can push to the scan one by one."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ok = F.lit(True)
    for c in cols:
        x = F.col(f"`{c}`")
        ok = ok & x.isNotNull()
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(x)
    return ok


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    value_col: str = "value",
    keep: Sequence[str] = (),
    corrupt_col: str | None = None,
) -> DataFrame:
    """Parse a JSON text/binary column with a fixed schema and flatten it.

    Undecodable text gives an all-null record; a wrongly typed field gives a
    null field. With ``corrupt_col`` set, a boolean column marks the rows
    that are no usable record: a null value, text that isn't a JSON object
    (an array counts as one bad message), or an object without any field of
    the schema.
    """
    text = F.col(value_col).cast("string")
    cols: list[Column | str] = [*keep, F.from_json(text, schema).alias("__rec")]
    if corrupt_col:
        cols.append(text.alias("__text"))
    out = df.select(*cols)
    flat: list[Column | str] = [*keep, "__rec.*"]
    if corrupt_col:
        # from_json turns junk into an all-null record. Only rows whose fields
        # all came back null have their keys looked at (short-circuit AND).
        all_null = F.coalesce(*[F.col("__rec")[f.name].cast("string") for f in schema.fields]).isNull()
        names = F.array(*[F.lit(f.name) for f in schema.fields])
        known = F.arrays_overlap(F.json_object_keys(F.col("__text")), names)
        flat.append((all_null & ~F.coalesce(known, F.lit(False))).alias(corrupt_col))
    return out.select(*flat)


def encode_keyed(
    df: DataFrame,
    cols: Sequence[str],
    key_col: str | None = "src_ip",
) -> DataFrame:
    """``key`` = key column bytes (empty → null), ``value`` = JSON of ``cols``.

    Null fields are left out of the JSON text.
    """
    value = F.to_json(F.struct(*[c for c in cols if c in df.columns]))
    if key_col is None:
        key = F.lit(None).cast("binary")
    else:
        key = F.nullif(F.col(key_col).cast("string"), F.lit("")).cast("binary")
    return df.select(key.alias("key"), value.alias("value"))
