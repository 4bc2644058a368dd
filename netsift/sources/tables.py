"""Connection records derived from the driver's star-schema tables.

``lineitem ⋈ orders ⋈ part`` stands in for a Zeek ``conn`` log: every
connection-record column is a pure expression of one joined row (see
FIXTURES.md §2). Only the referenced columns are read, so Parquet scans
prune to 11 + 3 + 4 columns.

Scale notes. Both joins are equi-joins on keys with at most seven lineitem
rows per order and a bounded number per part, so neither side is skewed.
No broadcast is forced: Spark broadcasts ``part`` or ``orders`` only when
their measured size is below ``spark.sql.autoBroadcastJoinThreshold`` (and
AQE re-checks it at run time); beyond that they are sort-merge joins.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINEITEM_COLS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
ORDERS_COLS = ("o_orderkey", "o_orderpriority", "o_orderstatus")
PART_COLS = ("p_partkey", "p_type", "p_brand", "p_size")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def joined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLS)
    o = table(spark, sf_dir, "orders").select(*ORDERS_COLS)
    p = table(spark, sf_dir, "part").select(*PART_COLS)
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(
        p, F.col("l_partkey") == F.col("p_partkey")
    )


def _c(name: str) -> Column:
    return F.col(name)


def _s(c: Column) -> Column:
    return c.cast("string")


def record_key() -> Column:
    return F.concat_ws(
        "|", _s(_c("l_orderkey")), _s(_c("l_linenumber")), _s(_c("l_partkey")), _s(_c("l_suppkey"))
    )


def conn_columns() -> dict[str, Column]:
    """Connection-record columns as expressions over one joined row."""
    ln, rf = _c("l_linenumber"), _c("l_returnflag")
    price, disc, tax, qty = _c("l_extendedprice"), _c("l_discount"), _c("l_tax"), _c("l_quantity")
    pk, sk, ok = _c("l_partkey"), _c("l_suppkey"), _c("l_orderkey")
    resp_bytes = F.floor(price * disc).cast("double")
    return {
        "key": record_key(),
        "src_ip": F.concat_ws(".", _s((pk * 37) % 256), _s(sk % 256), _s(ln), _s(ok % 256)),
        "dest_ip": F.when((ln == 5) & (rf == "A"), F.lit("fe80::1")).otherwise(
            F.concat_ws(".", _s((sk * 53) % 256), _s(pk % 256), F.lit("0"), F.lit("1"))
        ),
        "src_port": F.when((ln == 1) & (qty < 6), F.lit(0.0))
        .otherwise(F.lit(1024) + (ok * 7919 + pk) % 64512)
        .cast("double"),
        "dest_port": F.when(sk % 5 == 0, F.lit(53))
        .when(sk % 5 == 1, F.lit(80))
        .when(sk % 5 == 2, F.lit(443))
        .when(sk % 5 == 3, F.lit(22))
        .otherwise(F.lit(1024) + (pk * 31) % 64512)
        .cast("double"),
        "protocol": F.when(rf == "A", "tcp").when(rf == "N", "udp").when(rf == "R", "icmp"),
        "conn_state": F.when(_c("o_orderpriority") == "1-URGENT", "S0")
        .when(_c("o_orderpriority") == "2-HIGH", "SF")
        .when(_c("o_orderpriority") == "3-MEDIUM", "REJ")
        .when(_c("o_orderpriority") == "5-LOW", "OTH")
        .otherwise("RSTO"),
        "service": F.lower(_c("p_type")),
        "history": _c("p_brand"),
        "duration": (qty / 8.0).cast("double"),
        "orig_bytes": F.when((ln == 7) & (rf == "R"), F.lit(None).cast("double")).otherwise(
            F.floor(price).cast("double")
        ),
        "orig_pkts": qty.cast("double"),
        "orig_ip_bytes": F.floor(price * (F.lit(1) + tax)).cast("double"),
        "resp_bytes": resp_bytes,
        "resp_pkts": _c("p_size").cast("double"),
        "resp_ip_bytes": (resp_bytes + F.lit(40) * _c("p_size")).cast("double"),
        "missed_bytes": F.when(ln == 3, pk % 1000).otherwise(F.lit(0)).cast("double"),
        "local_orig": _c("l_linestatus") == "O",
        "local_resp": F.when(
            (_c("o_orderstatus") == "P") & (ln == 6), F.lit(None).cast("boolean")
        ).otherwise(_c("o_orderstatus") == "F"),
        "label_multi": F.when(disc < 0.06, "none")
        .when((tax >= 0.08) & (qty > 45), "T1009")
        .when(_c("p_size") <= 25, "T1000")
        .when(_c("p_size") <= 40, "T1001")
        .otherwise("T1002"),
        "rule_label": F.when(
            (F.floor(price * disc) * 16 < F.floor(price))
            & ~((rf == "R") & (_c("o_orderpriority") == "1-URGENT")),
            "none",
        )
        .when(_c("p_size") <= 20, "T1000")
        .when(_c("p_size") <= 44, "T1001")
        .otherwise("T1002"),
    }


def conn_records(spark: SparkSession, sf_dir: str, with_time: bool = False, joined: DataFrame | None = None) -> DataFrame:
    """One connection record per lineitem row, plus ``key`` and ``rule_label``.

    ``joined`` are the rows of :func:`joined_rows` if a caller has them already.

    ``rule_label`` is a fixed rule standing in for a model prediction so that
    metric operators can be checked without training anything.
    """
    cols = conn_columns()
    if with_time:
        cols["ts"] = F.col("l_shipdate")
    joined = joined_rows(spark, sf_dir) if joined is None else joined
    return joined.select(*[e.alias(n) for n, e in cols.items()])


def raw_records(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """The same records under raw Zeek names, with ``uid``/``ts``/... present."""
    conn = conn_records(spark, sf_dir, with_time=True, joined=joined)
    return conn.select(
        F.col("key").alias("uid"),
        F.md5(F.col("key")).alias("community_id"),
        F.col("ts"),
        F.col("ts").cast("string").alias("datetime"),
        F.col("src_ip").alias("src_ip_zeek"),
        F.col("dest_ip").alias("dest_ip_zeek"),
        F.col("src_port").alias("src_port_zeek"),
        F.col("dest_port").alias("dest_port_zeek"),
        F.col("protocol").alias("proto"),
        "conn_state",
        "service",
        "history",
        "duration",
        "orig_bytes",
        "orig_pkts",
        "orig_ip_bytes",
        "resp_bytes",
        "resp_pkts",
        "resp_ip_bytes",
        "missed_bytes",
        "local_orig",
        "local_resp",
        F.col("label_multi").alias("label_tactic"),
    )


def _wire_bool(c: Column, ln: Column) -> Column:
    """Booleans travel as text: ``True/False``, ``yes/no`` or ``1/0`` by line."""
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(ln % 3 == 0, F.when(c, "True").otherwise("False"))
        .when(ln % 3 == 1, F.when(c, "yes").otherwise("no"))
        .otherwise(F.when(c, "1").otherwise("0"))
    )


def text_columns() -> dict[str, Column]:
    """All record columns as text, the way a CSV or an API hands them over.

    ``duration`` is ``'-'`` (Zeek's "unset") for one order in 89; booleans use
    the three spellings of :func:`_wire_bool`. ``rule_label`` comes last.
    """
    cols = conn_columns()
    out: dict[str, Column] = {"key": cols["key"]}
    for name, expr in cols.items():
        if name in ("key", "rule_label"):
            continue
        if name in ("local_orig", "local_resp"):
            out[name] = _wire_bool(expr, F.col("l_linenumber"))
        elif name == "duration":
            out[name] = F.when(F.col("l_orderkey") % 89 == 0, F.lit("-")).otherwise(
                expr.cast("string")
            )
        else:
            out[name] = expr.cast("string")
    out["rule_label"] = cols["rule_label"]
    return out


def text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The connection records with every column as text."""
    return joined_rows(spark, sf_dir).select(*[e.alias(n) for n, e in text_columns().items()])


def wire_records(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """Kafka-shaped rows: ``key`` = source IP bytes, ``value`` = JSON text.

    One order in 97 sends undecodable text; one in 89 sends ``duration`` as
    the string ``"-"``; on lines divisible by 3 the booleans arrive as the
    strings ``"True"``/``"False"`` instead of JSON booleans. Null fields are
    left out of the JSON, as ``to_json`` does. The fields that vary are put
    in front of one serialised struct of the others.
    """
    joined = joined_rows(spark, sf_dir) if joined is None else joined
    cols = conn_columns()
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    vary = ("duration", "local_orig", "local_resp")
    same = F.to_json(F.struct(*[e.alias(n) for n, e in cols.items() if n not in ("key", "rule_label", *vary)]))

    def member(name: str, json: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f'"{name}":'), json, F.lit(",")), F.lit(""))

    def truth(name: str) -> Column:
        spoken = F.when(ln % 3 == 0, F.when(cols[name], '"True"').otherwise('"False"'))
        return F.when(cols[name].isNotNull(), F.coalesce(spoken, cols[name].cast("string")))

    duration = F.when(ok % 89 == 0, F.lit('"-"')).otherwise(cols["duration"].cast("string"))
    members = [member("duration", duration), *[member(n, truth(n)) for n in vary[1:]]]
    whole = F.concat(F.lit("{"), *members, F.substring(same, 2, 2**31 - 1))
    value = F.when(ok % 97 == 0, F.lit("junk")).otherwise(whole)
    src_ip = cols["src_ip"]
    return joined.select(
        cols["key"].alias("record_key"),
        F.when(src_ip == "", F.lit(None)).otherwise(src_ip).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        cols["rule_label"].alias("rule_label"),
    )
