"""DuckDB SQL for each registered query (same keys, same column names)."""

from __future__ import annotations

from .sql_conn import hash_bucket_sql, unit_hash_sql, with_conn

SQL: dict[str, str] = {}

F12 = (
    "src_port, dest_port, protocol, conn_state, orig_bytes, orig_pkts, orig_ip_bytes, "
    "resp_bytes, resp_pkts, resp_ip_bytes, missed_bytes, local_resp"
)
F12_LABEL = F12 + ", label_multi"
NUMERIC = "duration orig_bytes orig_pkts orig_ip_bytes resp_bytes resp_pkts resp_ip_bytes missed_bytes".split()
PORTS = ["src_port", "dest_port"]
BOOLS = ["local_orig", "local_resp"]

# text_records twin: every column as text, '-' durations, three boolean spellings
TEXT_CTE = """text AS (
  SELECT key, rule_label, _ok, _ln,
    src_ip, dest_ip, CAST(src_port AS VARCHAR) AS src_port, CAST(dest_port AS VARCHAR) AS dest_port,
    protocol, conn_state, service, history,
    CASE WHEN _ok % 89 = 0 THEN '-' ELSE CAST(duration AS VARCHAR) END AS duration,
    CAST(orig_bytes AS VARCHAR) AS orig_bytes, CAST(orig_pkts AS VARCHAR) AS orig_pkts,
    CAST(orig_ip_bytes AS VARCHAR) AS orig_ip_bytes, CAST(resp_bytes AS VARCHAR) AS resp_bytes,
    CAST(resp_pkts AS VARCHAR) AS resp_pkts, CAST(resp_ip_bytes AS VARCHAR) AS resp_ip_bytes,
    CAST(missed_bytes AS VARCHAR) AS missed_bytes,
    {lo} AS local_orig, {lr} AS local_resp, label_multi
  FROM conn)"""


def _wire_bool(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN NULL "
        f"WHEN _ln % 3 = 0 THEN CASE WHEN {c} THEN 'True' ELSE 'False' END "
        f"WHEN _ln % 3 = 1 THEN CASE WHEN {c} THEN 'yes' ELSE 'no' END "
        f"ELSE CASE WHEN {c} THEN '1' ELSE '0' END END"
    )


TEXT = TEXT_CTE.format(lo=_wire_bool("local_orig"), lr=_wire_bool("local_resp"))


def _bool_to_double(c: str) -> str:
    s = f"CAST({c} AS VARCHAR)"
    return (
        f"CASE WHEN {s} = 'true' THEN 1.0 WHEN {s} = 'false' THEN 0.0 WHEN {c} IS NULL THEN 0.0 "
        f"ELSE TRY_CAST({s} AS DOUBLE) END"
    )


def _q(name: str, body: str, *ctes: str) -> None:
    SQL[name] = with_conn(body, *ctes)


_q("scan_project", f"SELECT key, {F12_LABEL} FROM conn")

_q(
    "rename_strict",
    "SELECT key, src_ip, dest_ip, src_port, dest_port, protocol, conn_state, service, history, duration, "
    "orig_bytes, orig_pkts, orig_ip_bytes, resp_bytes, resp_pkts, resp_ip_bytes, missed_bytes, "
    "local_orig, local_resp, label_multi FROM conn",
)

_q(
    "rename_tolerant",
    "SELECT key, src_port, dest_port, protocol, conn_state, orig_bytes, orig_pkts, orig_ip_bytes, resp_bytes, "
    f"resp_pkts, resp_ip_bytes, missed_bytes, {_bool_to_double('local_resp')} AS local_resp, label_multi "
    "FROM conn WHERE orig_bytes IS NOT NULL AND NOT isnan(orig_bytes) AND label_multi IS NOT NULL",
)

_q(
    "cast_numeric_ports",
    "SELECT key, " + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC + PORTS) + " FROM text",
    TEXT,
)

_q(
    "bool_to_double",
    "SELECT key, "
    + ", ".join(f"{_bool_to_double('(' + _wire_bool(c) + ')')} AS {c}_text" for c in BOOLS)
    + ", "
    + ", ".join(f"{_bool_to_double(c)} AS {c}" for c in BOOLS)
    + " FROM conn",
)

_q(
    "bool_to_int",
    "SELECT key, "
    + ", ".join(f"CAST(CASE WHEN CAST({c} AS VARCHAR) = 'false' THEN 0 ELSE 1 END AS INTEGER) AS {c}" for c in BOOLS)
    + " FROM conn",
)

_q(
    "wire_coercion",
    "SELECT key, "
    + ", ".join(f"coalesce(TRY_CAST({c} AS DOUBLE), 0.0) AS {c}" for c in NUMERIC + PORTS)
    + ", "
    + ", ".join(f"coalesce(lower(trim({c})) IN ('true', '1', 'yes'), false) AS {c}" for c in BOOLS)
    + " FROM text",
    TEXT,
)

_q("label_binary_a", "SELECT key, label_multi, CASE WHEN label_multi = 'none' THEN 1.0 ELSE 0.0 END AS label_bin FROM conn")

SQL["label_binary_b"] = """
WITH l AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' WHEN toxic = 0 THEN 'none' END AS label_multi FROM labels)
SELECT doc_id, label_multi,
  CASE WHEN label_multi <> 'none' THEN 0.0 ELSE 1.0 END AS label_bin,
  CASE WHEN label_multi = 'none' THEN 1.0 ELSE 0.0 END AS label_bin_a
FROM l
"""

_q(
    "dropna_subset",
    f"SELECT key, {F12_LABEL} FROM conn WHERE "
    + " AND ".join(f"{c.strip()} IS NOT NULL" for c in F12_LABEL.split(","))
    + " AND NOT isnan(orig_bytes)",
)

_q(
    "dropna_any",
    "SELECT * EXCLUDE (_ok, _ln) FROM conn WHERE "
    + " AND ".join(
        f"{c} IS NOT NULL"
        for c in "key src_ip dest_ip src_port dest_port protocol conn_state service history duration orig_bytes "
        "orig_pkts orig_ip_bytes resp_bytes resp_pkts resp_ip_bytes missed_bytes local_orig local_resp "
        "label_multi rule_label".split()
    ),
)

# decode(encode(x)): junk rows → all null and flagged; '-' durations → null;
# booleans sent as strings → null.
_DECODED = ", ".join(
    [
        "CASE WHEN _ok % 97 = 0 THEN NULL ELSE {c} END AS {c}".format(c=c)
        for c in "src_ip dest_ip src_port dest_port protocol conn_state service history".split()
    ]
    + ["CASE WHEN _ok % 97 = 0 OR _ok % 89 = 0 THEN NULL ELSE duration END AS duration"]
    + [
        "CASE WHEN _ok % 97 = 0 THEN NULL ELSE {c} END AS {c}".format(c=c)
        for c in "orig_bytes orig_pkts orig_ip_bytes resp_bytes resp_pkts resp_ip_bytes missed_bytes".split()
    ]
    + [f"CASE WHEN _ok % 97 = 0 OR _ln % 3 = 0 THEN NULL ELSE {c} END AS {c}" for c in BOOLS]
    + ["CASE WHEN _ok % 97 = 0 THEN NULL ELSE label_multi END AS label_multi"]
)
_q("json_decode", f"SELECT key AS record_key, {_DECODED}, (_ok % 97 = 0) AS _corrupt FROM conn")

_q(
    "json_encode_keyed",
    "SELECT nullif(src_ip, '') AS key, to_json(struct_pack(src_ip := src_ip, dest_ip := dest_ip, "
    "src_port := src_port, dest_port := dest_port, protocol := protocol, conn_state := conn_state, "
    "label_multi := label_multi, prediction := rule_label))::VARCHAR AS value FROM conn",
)

_q(
    "label_histogram",
    "SELECT label_multi, count(*) AS num_records FROM conn GROUP BY label_multi ORDER BY num_records DESC, label_multi",
)
_q("label_set", "SELECT DISTINCT label_multi FROM conn ORDER BY label_multi")

LABEL_INDEX_CTE = """lidx AS (
  SELECT label_multi, CAST(row_number() OVER (ORDER BY n DESC, label_multi) - 1 AS DOUBLE) AS label_multi_idx, n
  FROM (SELECT label_multi, count(*) AS n FROM conn WHERE label_multi IS NOT NULL GROUP BY label_multi))"""

_q("label_index", "SELECT label_multi, label_multi_idx, n FROM lidx", LABEL_INDEX_CTE)

_q(
    "top_attack_labels",
    "SELECT label_multi, count(*) AS num_records FROM conn WHERE label_multi <> 'none' "
    "GROUP BY label_multi ORDER BY num_records DESC, label_multi LIMIT 3",
)
_q("label_filter", f"SELECT key, {F12_LABEL} FROM conn WHERE label_multi = 'none'")

_q(
    "prediction_as_int",
    "SELECT c.key, coalesce(l.label_multi_idx, (SELECT CAST(count(*) AS DOUBLE) FROM lidx)) AS prediction, "
    "CAST(coalesce(l.label_multi_idx, (SELECT count(*) FROM lidx)) AS INTEGER) AS prediction_int "
    "FROM conn c LEFT JOIN lidx l ON c.rule_label = l.label_multi",
    LABEL_INDEX_CTE,
)

_q(
    "row_counts",
    "SELECT count(*) AS n_rows, "
    "count(CASE WHEN orig_bytes IS NOT NULL AND local_resp IS NOT NULL THEN 1 END) AS n_clean, "
    f"count(CASE WHEN {hash_bucket_sql('key', 1000, 'split|')} < 700 THEN 1 END) AS n_train, "
    f"count(CASE WHEN NOT ({hash_bucket_sql('key', 1000, 'split|')} < 700) THEN 1 END) AS n_test, "
    "count(CASE WHEN label_multi = 'none' THEN 1 END) AS n_benign, "
    "count(CASE WHEN label_multi <> 'none' THEN 1 END) AS n_attack FROM conn",
)


def oracle_sql() -> dict[str, str]:
    from . import oracle_models, oracle_more, oracle_runs, oracle_stream  # noqa: F401

    return dict(SQL)


__all__ = ["SQL", "oracle_sql", "unit_hash_sql", "hash_bucket_sql", "LABEL_INDEX_CTE", "TEXT"]
