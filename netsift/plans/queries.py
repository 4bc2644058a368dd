"""Registered queries: one per operator of the inventory, over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input. The DuckDB text of the same computation lives in
:mod:`netsift.plans.oracle` under the same key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.casts import bool_to_double, bool_to_int, to_double
from ..functions.hashing import hash_bucket
from ..operators import clean, labels, schema
from ..sources import tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


F12_LABEL = list(C.F12_FEATURES) + [C.LABEL_COL]


# --- sources, schema -------------------------------------------------------


@register("scan_project")
def scan_project(spark, sf):
    return schema.keep_present(tables.conn_records(spark, sf), ["key", *F12_LABEL, "no_such_column"])


@register("rename_strict")
def rename_strict(spark, sf):
    raw = tables.raw_records(spark, sf)
    renamed = schema.rename_strict(raw, C.STRICT_RENAME)
    return schema.drop_columns(renamed, ["community_id", "ts", "datetime"], strict=True).withColumnRenamed(
        "uid", "key"
    )


@register("rename_tolerant")
def rename_tolerant(spark, sf):
    """The evaluation loader: rename, drop, keep f12, cast, drop nulls."""
    raw = tables.raw_records(spark, sf)
    df = schema.rename_tolerant(raw, C.TOLERANT_RENAME, label_col=None)
    df = df.withColumnRenamed("uid", "key")
    df = schema.drop_columns(df, C.F12_DROP)
    df = schema.keep_present(df, ["key", *F12_LABEL])
    df = clean.cast_columns(df)
    return clean.drop_null_subset(df, F12_LABEL)


# --- scalar coercions ------------------------------------------------------


@register("cast_numeric_ports")
def cast_numeric_ports(spark, sf):
    t = tables.text_records(spark, sf)
    cols = list(C.NUMERIC_COLS + C.PORT_COLS)
    return t.select("key", *[to_double(c).alias(c) for c in cols])


@register("bool_to_double")
def bool_to_double_q(spark, sf):
    text, typed = tables.text_columns(), tables.conn_columns()
    return tables.joined_rows(spark, sf).select(
        typed["key"].alias("key"),
        *[bool_to_double(text[c]).alias(f"{c}_text") for c in C.BOOLEAN_COLS],
        *[bool_to_double(typed[c]).alias(c) for c in C.BOOLEAN_COLS],
    )


@register("bool_to_int")
def bool_to_int_q(spark, sf):
    conn = tables.conn_records(spark, sf)
    return conn.select("key", *[bool_to_int(c).alias(c) for c in C.BOOLEAN_COLS])


@register("wire_coercion")
def wire_coercion(spark, sf):
    t = tables.text_records(spark, sf)
    return clean.wire_coerce(t).select("key", *C.NUMERIC_COLS, *C.PORT_COLS, *C.BOOLEAN_COLS)


@register("label_binary_a")
def label_binary_a(spark, sf):
    conn = tables.conn_records(spark, sf)
    return conn.select("key", C.LABEL_COL, labels.binary_label_a().alias("label_bin"))


@register("label_binary_b")
def label_binary_b(spark, sf):
    """Second label source: toxic documents are the 'attack' class; no label → null."""
    lab = tables.table(spark, sf, "labels")
    name = F.when(F.col("toxic") == 1, F.lit("toxic")).when(F.col("toxic") == 0, F.lit(C.BENIGN_LABEL))
    return lab.select(
        "doc_id",
        name.alias(C.LABEL_COL),
        labels.binary_label_b(name).alias("label_bin"),
        labels.binary_label_a(name).alias("label_bin_a"),
    )


@register("dropna_subset")
def dropna_subset(spark, sf):
    conn = tables.conn_records(spark, sf)
    return clean.drop_null_subset(schema.keep_present(conn, ["key", *F12_LABEL]), F12_LABEL)


@register("dropna_any")
def dropna_any(spark, sf):
    return clean.drop_null_any(tables.conn_records(spark, sf))


@register("json_decode")
def json_decode(spark, sf):
    wire = tables.wire_records(spark, sf)
    return clean.decode_json(wire, C.conn_schema(), keep=["record_key"], corrupt_col="_corrupt")


@register("json_encode_keyed")
def json_encode_keyed(spark, sf):
    conn = tables.conn_records(spark, sf).withColumnRenamed("rule_label", "prediction")
    cols = [c for c in C.OUTPUT_COLS if c != "predicted_label"]
    return clean.encode_keyed(conn, cols).select(F.col("key").cast("string").alias("key"), "value")


# --- labels ------------------------------------------------------------------


@register("label_histogram")
def label_histogram(spark, sf):
    return labels.label_histogram(tables.conn_records(spark, sf))


@register("label_set")
def label_set(spark, sf):
    return labels.label_set(tables.conn_records(spark, sf))


@register("label_index")
def label_index(spark, sf):
    return labels.frequency_index(tables.conn_records(spark, sf), C.LABEL_COL)


@register("top_attack_labels")
def top_attack_labels(spark, sf):
    return labels.top_attack_labels(tables.conn_records(spark, sf), k=3)


@register("label_filter")
def label_filter(spark, sf):
    conn = tables.conn_records(spark, sf)
    return conn.filter(F.col(C.LABEL_COL) == C.BENIGN_LABEL).select("key", *F12_LABEL)


@register("prediction_as_int")
def prediction_as_int(spark, sf):
    conn = tables.conn_records(spark, sf)
    d = labels.frequency_index(conn, C.LABEL_COL)
    scored = labels.apply_index(conn.select("key", "rule_label"), d, "rule_label", dict_col=C.LABEL_COL)
    return scored.select(
        "key",
        F.col("rule_label_idx").cast("double").alias("prediction"),
        F.col("rule_label_idx").cast("int").alias("prediction_int"),
    )


@register("row_counts")
def row_counts(spark, sf):
    conn = tables.conn_records(spark, sf)
    clean_ok = F.col("orig_bytes").isNotNull() & F.col("local_resp").isNotNull()
    train = hash_bucket("key", 1000, "split|") < 700
    return conn.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(clean_ok, 1)).alias("n_clean"),
        F.count(F.when(train, 1)).alias("n_train"),
        F.count(F.when(~train, 1)).alias("n_test"),
        F.count(F.when(F.col(C.LABEL_COL) == C.BENIGN_LABEL, 1)).alias("n_benign"),
        F.count(F.when(F.col(C.LABEL_COL) != C.BENIGN_LABEL, 1)).alias("n_attack"),
    )


def queries() -> dict[str, Query]:
    # import side modules so their @register calls run
    from . import queries_models, queries_more, queries_runs, queries_stream  # noqa: F401

    return dict(REGISTRY)
