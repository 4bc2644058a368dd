"""DuckDB text of the connection-record projection (the oracle's view).

The same expressions as :mod:`netsift.sources.tables`, written once in
ANSI-ish SQL so every oracle query can start with ``WITH conn AS (...)``.
"""

from __future__ import annotations

CONN_SELECT = """
SELECT
  concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS key,
  concat_ws('.', (l_partkey*37)%256, l_suppkey%256, l_linenumber, l_orderkey%256) AS src_ip,
  CASE WHEN l_linenumber = 5 AND l_returnflag = 'A' THEN 'fe80::1'
       ELSE concat_ws('.', (l_suppkey*53)%256, l_partkey%256, '0', '1') END AS dest_ip,
  CAST(CASE WHEN l_linenumber = 1 AND l_quantity < 6 THEN 0
            ELSE 1024 + (l_orderkey*7919 + l_partkey) % 64512 END AS DOUBLE) AS src_port,
  CAST(CASE l_suppkey % 5 WHEN 0 THEN 53 WHEN 1 THEN 80 WHEN 2 THEN 443 WHEN 3 THEN 22
            ELSE 1024 + (l_partkey*31) % 64512 END AS DOUBLE) AS dest_port,
  CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'N' THEN 'udp' WHEN 'R' THEN 'icmp' END AS protocol,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'S0' WHEN '2-HIGH' THEN 'SF' WHEN '3-MEDIUM' THEN 'REJ'
       WHEN '5-LOW' THEN 'OTH' ELSE 'RSTO' END AS conn_state,
  lower(p_type) AS service,
  p_brand AS history,
  CAST(l_quantity / 8.0 AS DOUBLE) AS duration,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL
       ELSE CAST(floor(l_extendedprice) AS DOUBLE) END AS orig_bytes,
  CAST(l_quantity AS DOUBLE) AS orig_pkts,
  CAST(floor(l_extendedprice * (1 + l_tax)) AS DOUBLE) AS orig_ip_bytes,
  CAST(floor(l_extendedprice * l_discount) AS DOUBLE) AS resp_bytes,
  CAST(p_size AS DOUBLE) AS resp_pkts,
  CAST(floor(l_extendedprice * l_discount) + 40 * p_size AS DOUBLE) AS resp_ip_bytes,
  CAST(CASE WHEN l_linenumber = 3 THEN l_partkey % 1000 ELSE 0 END AS DOUBLE) AS missed_bytes,
  l_linestatus = 'O' AS local_orig,
  CASE WHEN o_orderstatus = 'P' AND l_linenumber = 6 THEN NULL ELSE o_orderstatus = 'F' END AS local_resp,
  CASE WHEN l_discount < 0.06 THEN 'none'
       WHEN l_tax >= 0.08 AND l_quantity > 45 THEN 'T1009'
       WHEN p_size <= 25 THEN 'T1000'
       WHEN p_size <= 40 THEN 'T1001'
       ELSE 'T1002' END AS label_multi,
  CASE WHEN floor(l_extendedprice * l_discount) * 16 < floor(l_extendedprice)
            AND NOT (l_returnflag = 'R' AND o_orderpriority = '1-URGENT') THEN 'none'
       WHEN p_size <= 20 THEN 'T1000'
       WHEN p_size <= 44 THEN 'T1001'
       ELSE 'T1002' END AS rule_label,
  l_orderkey AS _ok,
  l_linenumber AS _ln
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
"""


def with_conn(body: str, *extra_ctes: str) -> str:
    """``WITH conn AS (...) [, more] <body>``."""
    ctes = [f"conn AS ({CONN_SELECT})", *extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def unit_hash_sql(key: str, salt: str) -> str:
    """DuckDB twin of :func:`netsift.functions.hashing.unit_hash`."""
    return f"CAST(('0x' || substr(md5(concat('{salt}', {key})), 1, 8))::UBIGINT AS DOUBLE) / 4294967296.0"


def hash_bucket_sql(key: str, buckets: int, salt: str) -> str:
    return f"(('0x' || substr(md5(concat('{salt}', {key})), 1, 8))::UBIGINT % {buckets})"
