"""DuckDB SQL for the streaming queries (batch twins)."""

from __future__ import annotations

from .. import config as C
from .oracle import SQL, _bool_to_double
from .sql_conn import hash_bucket_sql, with_conn

BOOLS = ["local_orig", "local_resp"]
TEXT_COLS = "src_ip dest_ip src_port dest_port protocol conn_state service history".split()
NUM_COLS = "orig_bytes orig_pkts orig_ip_bytes resp_bytes resp_pkts resp_ip_bytes missed_bytes".split()

_JUNK = "_ok % 97 = 0"
_DECODED_CAST = ", ".join(
    [f"CASE WHEN {_JUNK} THEN NULL ELSE {c} END AS {c}" for c in TEXT_COLS]
    + [f"CASE WHEN {_JUNK} OR _ok % 89 = 0 THEN NULL ELSE duration END AS duration"]
    + [f"CASE WHEN {_JUNK} THEN NULL ELSE {c} END AS {c}" for c in NUM_COLS]
    + [
        _bool_to_double(f"(CASE WHEN {_JUNK} OR _ln % 3 = 0 THEN NULL ELSE {c} END)") + f" AS {c}"
        for c in BOOLS
    ]
    + [f"CASE WHEN {_JUNK} THEN NULL ELSE label_multi END AS label_multi"]
)

SQL["stream_decode"] = with_conn(f"SELECT nullif(src_ip, '') AS key, {_DECODED_CAST}, ({_JUNK}) AS _corrupt FROM conn")

SQL["stream_route"] = (
    "SELECT unnest(['predictions', CASE WHEN prediction = 1.0 THEN 'benign' ELSE 'attack' END]) AS topic, "
    "event_id, prediction FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END AS prediction FROM events)"
)

SQL["stream_deadletter"] = with_conn(
    "SELECT unnest(CASE WHEN corrupt THEN ['deadletter'] ELSE ['predictions', "
    "CASE WHEN prediction = 1.0 THEN 'benign' ELSE 'attack' END] END) AS topic, key, prediction FROM "
    f"(SELECT nullif(src_ip, '') AS key, ({_JUNK}) AS corrupt, "
    f"CASE WHEN {_JUNK} THEN 0.0 WHEN resp_bytes * 16 < orig_bytes THEN 1.0 ELSE 0.0 END AS prediction FROM conn)"
)

# the same rows as the unbroken run
SQL["stream_restart"] = SQL["stream_deadletter"]

SQL["deliver_once"] = with_conn(
    "SELECT src_ip, dest_ip, src_port, dest_port, label_multi, "
    "CASE WHEN resp_bytes * 16 < orig_bytes THEN 1.0 ELSE 0.0 END AS prediction "
    f"FROM conn WHERE NOT ({_JUNK})"
)

SQL["wire_hash_split_counts"] = with_conn(
    f"SELECT CASE WHEN {hash_bucket_sql('key', 1000, 'split|')} < 700 THEN 'train' ELSE 'test' END AS split, label_multi, "
    "count(*) AS n, CAST(sum(CASE WHEN label_multi = 'none' THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS n_benign "
    "FROM conn GROUP BY ALL"
)

__all__ = ["SQL", "C"]
