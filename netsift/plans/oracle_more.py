"""DuckDB SQL for the balance, feature, metric and routing queries."""

from __future__ import annotations

from .. import config as C
from .oracle import LABEL_INDEX_CTE, SQL, _bool_to_double
from .sql_conn import hash_bucket_sql, unit_hash_sql, with_conn

P = C.ATTACK_SHARE
K = C.TOP_K_LABELS
F12_NUMERIC = [c for c in C.F12_FEATURES if c not in ("protocol", "conn_state")]
NUMERIC = list(C.NUMERIC_COLS)
INNER = [i / 8 for i in range(1, 8)]
FULL8 = [i / 8 for i in range(0, 9)]

GOLDEN_INNER_EDGES = {
    "src_port": [27423, 34983, 37675, 40367, 43057, 45771, 52896],
    "dest_port": [53, 123, 4848],
    "orig_bytes": [43, 47, 64, 163, 686, 1043],
    "orig_pkts": [1, 3, 6, 40, 44, 48],
    "orig_ip_bytes": [71, 86, 202, 336, 4856, 5480, 6552],
    "resp_bytes": [0, 43, 58, 163, 11329, 16681],
    "resp_pkts": [0, 1, 3, 48, 68],
    "resp_ip_bytes": [0, 71, 86, 247, 47844, 70292],
    "missed_bytes": [0],
    "local_resp": [0],
}


def _list(vals) -> str:
    return "[" + ", ".join(repr(float(v)) for v in vals) + "]"


def _q(name: str, body: str, *ctes: str) -> None:
    SQL[name] = with_conn(body, *ctes)


# --- balance -------------------------------------------------------------------

PLAN_CTES = (
    "hist AS (SELECT label_multi, count(*) AS n FROM conn GROUP BY label_multi)",
    "bcount AS (SELECT CAST(sum(n) AS DOUBLE) AS benign_rows FROM hist WHERE label_multi = 'none')",
    f"top AS (SELECT label_multi, n FROM hist WHERE label_multi <> 'none' ORDER BY n DESC, label_multi LIMIT {K})",
    "plan0 AS (SELECT label_multi AS slice, n AS attack_rows, "
    f"(CAST({1.0 - P!r} AS DOUBLE) * CAST(n AS DOUBLE)) / CAST({P!r} AS DOUBLE) AS benign_needed, benign_rows "
    "FROM top, bcount)",
    "plan AS (SELECT slice, attack_rows, benign_needed, benign_rows, "
    "CAST(floor(benign_needed / benign_rows) AS INTEGER) AS copies, "
    "fmod(benign_needed, benign_rows) / benign_rows AS fraction FROM plan0)",
)
REBALANCED_CTES = PLAN_CTES + (
    "att AS (SELECT c.label_multi AS slice, c.key, 0 AS copy, c.label_multi FROM conn c JOIN plan p ON c.label_multi = p.slice)",
    "ben AS (SELECT p.slice, c.key, c.label_multi, "
    "p.copies + CASE WHEN c.u < p.fraction THEN 1 ELSE 0 END AS k FROM "
    f"(SELECT key, label_multi, {unit_hash_sql('key', 'sample|')} AS u FROM conn WHERE label_multi = 'none') c "
    "CROSS JOIN plan p)",
    "benx AS (SELECT slice, key, CAST(unnest(range(1, k + 1)) AS INTEGER) AS copy, label_multi FROM ben WHERE k > 0)",
    "reb AS (SELECT slice, key, copy, label_multi FROM att UNION ALL SELECT slice, key, copy, label_multi FROM benx)",
)

_q("benign_needed", "SELECT * FROM plan", *PLAN_CTES)
_q(
    "hash_sample",
    f"SELECT key, label_multi FROM conn WHERE label_multi = 'none' AND {unit_hash_sql('key', 'sample|')} < 0.25",
)
_q(
    "label_slices",
    "SELECT label_multi AS slice, key FROM conn WHERE label_multi IN "
    "(SELECT label_multi FROM (SELECT label_multi, count(*) AS n FROM conn WHERE label_multi <> 'none' "
    "GROUP BY label_multi ORDER BY n DESC, label_multi LIMIT 3))",
)
_q("single_slice", f"SELECT key, '{C.ALL_LABELS_SLICE}' AS slice, label_multi FROM conn")
_q("rebalanced_rows", "SELECT * FROM reb", *REBALANCED_CTES)
_q("rebalanced_counts", "SELECT slice, label_multi, count(*) AS n_rows FROM reb GROUP BY slice, label_multi", *REBALANCED_CTES)
_q(
    "min_rows_gate",
    f"SELECT slice, count(*) AS n_rows FROM reb GROUP BY slice HAVING count(*) >= {C.MIN_SLICE_ROWS}",
    *REBALANCED_CTES,
)
_q(
    "hash_split",
    f"SELECT key, CASE WHEN {hash_bucket_sql('key', 1000, 'split|')} < 700 THEN 'train' ELSE 'test' END AS split FROM conn",
)
SQL["page_slice"] = (
    "SELECT event_id, event_type, CAST(floor(event_id / 1000) AS BIGINT) AS page, "
    "CAST(floor(event_id / 1000) AS BIGINT) * 1000 AS page_offset FROM events"
)

# --- features --------------------------------------------------------------------

CLEAN_CTE = (
    "cf AS (SELECT key, src_port, dest_port, protocol, conn_state, orig_bytes, orig_pkts, orig_ip_bytes, "
    f"resp_bytes, resp_pkts, resp_ip_bytes, missed_bytes, {_bool_to_double('local_resp')} AS local_resp, "
    "label_multi, rule_label FROM conn WHERE orig_bytes IS NOT NULL AND NOT isnan(orig_bytes) AND label_multi IS NOT NULL)"
)


def _quantiles_cte(name: str, src: str, cols, probs) -> str:
    parts = [
        f"SELECT '{c}' AS feature, quantile_disc({c}, {_list(probs)}) AS q FROM {src} "
        f"WHERE {c} IS NOT NULL AND NOT isnan({c})"
        for c in cols
    ]
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


_q(
    "column_quantiles",
    "SELECT feature, CAST(i AS DOUBLE) / 8.0 AS p, q[i] AS q FROM qs, range(1, 8) t(i)",
    CLEAN_CTE,
    _quantiles_cte("qs", "cf", F12_NUMERIC, INNER),
)


def _bucket(x: str, splits: str) -> str:
    idx = f"(len(list_filter({splits}, lambda e: e <= {x})) - 1)"
    return (
        f"CAST(CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN len({splits}) - 1 "
        f"ELSE least(greatest({idx}, 0), len({splits}) - 2) END AS DOUBLE)"
    )


QUANTILE_BINS_CTES = (CLEAN_CTE, _quantiles_cte("qs", "cf", F12_NUMERIC, FULL8))


def quantile_bins_body(*extra: str) -> str:
    return (
        f"SELECT {', '.join(['key', *extra])}, "
        + ", ".join(f"{_bucket(c, f's_{c}')} AS {c}_bin" for c in F12_NUMERIC)
        + " FROM cf, ("
        + "SELECT "
        + ", ".join(
            f"(SELECT list_concat([-'inf'::DOUBLE], list_sort(list_distinct(q[2:{len(FULL8) - 1}])), ['inf'::DOUBLE]) "
            f"FROM qs WHERE feature = '{c}') AS s_{c}"
            for c in F12_NUMERIC
        )
        + ") sp"
    )


_q("quantile_bins", quantile_bins_body(), *QUANTILE_BINS_CTES)

_q(
    "fixed_edge_bins",
    "SELECT key, "
    + ", ".join(
        f"CAST(len(list_filter({_list(e)}, lambda v: v <= {c})) AS DOUBLE) AS {c}_bin" for c, e in GOLDEN_INNER_EDGES.items()
    )
    + " FROM cf",
    CLEAN_CTE,
)


def _trimmed(c: str, q: str, bins: int = 10) -> str:
    lo, hi = f"{q}[1]", f"{q}[2]"
    return (
        f"CAST(CASE WHEN {c} IS NULL OR isnan({c}) THEN -1 WHEN {c} < {lo} THEN 0 WHEN {c} > {hi} THEN {bins + 1} "
        f"WHEN {hi} = {lo} THEN 1 "
        f"ELSE 1 + least(CAST(floor(({c} - {lo}) / ({hi} - {lo}) * {float(bins)!r}) AS INTEGER), {bins - 1}) END AS INTEGER)"
    )


def _trim_select(src: str) -> str:
    return "(SELECT " + ", ".join(f"(SELECT q FROM tq WHERE feature = '{c}') AS t_{c}" for c in NUMERIC) + ") tp"


TRIM_PROBS = [C.NUMERIC_TRIM, 1.0 - C.NUMERIC_TRIM]
_q(
    "trimmed_numeric_bins",
    "SELECT key, " + ", ".join(f"{_trimmed(c, f't_{c}')} AS {c}_bin" for c in NUMERIC) + " FROM conn, " + _trim_select("conn"),
    _quantiles_cte("tq", "conn", NUMERIC, TRIM_PROBS),
)

CATS = list(C.CATEGORICAL_COLS)
NOMINAL_CTES = (
    "ncount AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM conn WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATS
    )
    + ")",
    "nrank AS (SELECT feature, value, n, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS rnk, "
    "sum(n) OVER (PARTITION BY feature ORDER BY n DESC, value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before, "
    "sum(n) OVER (PARTITION BY feature) AS tot FROM ncount)",
    f"kept AS (SELECT feature, value, rnk AS idx, count(*) OVER (PARTITION BY feature) AS other_idx FROM nrank "
    f"WHERE before / tot < {C.NOMINAL_SHARE!r})",
)


def _nominal(c: str, src: str = "conn") -> str:
    return (
        f"CAST(coalesce((SELECT idx FROM kept k WHERE k.feature = '{c}' AND k.value = CAST({src}.{c} AS VARCHAR)), "
        f"(SELECT max(other_idx) FROM kept k WHERE k.feature = '{c}'), 0) AS INTEGER)"
    )


_q("nominal_bins", "SELECT key, " + ", ".join(f"{_nominal(c)} AS {c}_bin" for c in CATS) + " FROM conn", *NOMINAL_CTES)

OCT = "([0-9]{1,3})"
IPV4 = rf"^{OCT}\.{OCT}\.{OCT}\.{OCT}$"


def _ip(c: str) -> str:
    octs = [f"TRY_CAST(regexp_extract({c}, '{IPV4}', {i}) AS INTEGER)" for i in range(1, 5)]
    valid = f"regexp_matches({c}, '{IPV4}') AND " + " AND ".join(f"{o} <= 255" for o in octs)
    first = octs[0]
    return (
        f"CAST(CASE WHEN {c} IS NULL OR NOT coalesce({valid}, false) THEN 0 WHEN {first} <= 127 THEN 1 "
        f"WHEN {first} <= 191 THEN 2 WHEN {first} <= 223 THEN 3 WHEN {first} <= 239 THEN 4 ELSE 5 END AS INTEGER)"
    )


def _port(c: str) -> str:
    return (
        f"CAST(CASE WHEN {c} IS NULL THEN 0 WHEN {c} >= 0 AND {c} < 1024 THEN 1 "
        f"WHEN {c} >= 1024 AND {c} < 49152 THEN 2 WHEN {c} >= 49152 AND {c} < 65536 THEN 3 ELSE 0 END AS INTEGER)"
    )


def _boolbin(c: str) -> str:
    return f"CAST(CASE WHEN {c} IS NULL THEN 2 WHEN {c} THEN 1 ELSE 0 END AS INTEGER)"


_q("ip_bins", "SELECT key, " + ", ".join(f"{_ip(c)} AS {c}_bin" for c in C.IP_COLS) + " FROM conn")
_q("port_bins", "SELECT key, " + ", ".join(f"{_port(c)} AS {c}_bin" for c in C.PORT_COLS) + " FROM conn")
_q("bool_bins", "SELECT key, " + ", ".join(f"{_boolbin(c)} AS {c}_bin" for c in C.BOOLEAN_COLS) + " FROM conn")

_q(
    "full_binning",
    "SELECT key, "
    + ", ".join(
        [f"{_ip(c)} AS {c}_bin" for c in C.IP_COLS]
        + [f"{_port(c)} AS {c}_bin" for c in C.PORT_COLS]
        + [f"{_boolbin(c)} AS {c}_bin" for c in C.BOOLEAN_COLS]
        + [f"{_trimmed(c, f't_{c}')} AS {c}_bin" for c in NUMERIC]
        + [f"{_nominal(c)} AS {c}_bin" for c in CATS]
    )
    + " FROM conn, "
    + _trim_select("conn"),
    _quantiles_cte("tq", "conn", NUMERIC, TRIM_PROBS),
    *NOMINAL_CTES,
)

_q(
    "distinct_per_feature",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(count(DISTINCT CAST({c} AS VARCHAR)) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct FROM conn"
        for c in C.PRESETS["f16"]
    ),
)

# --- metrics ---------------------------------------------------------------------

SCORED_CTES = (
    LABEL_INDEX_CTE,
    "scored AS (SELECT c.key, c.label_multi, c.rule_label, "
    "coalesce(a.label_multi_idx, (SELECT CAST(count(*) AS DOUBLE) FROM lidx)) AS label, "
    "coalesce(b.label_multi_idx, (SELECT CAST(count(*) AS DOUBLE) FROM lidx)) AS prediction "
    "FROM conn c LEFT JOIN lidx a ON c.label_multi = a.label_multi LEFT JOIN lidx b ON c.rule_label = b.label_multi)",
    "counts AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction)",
)


def _metric_ctes(counts: str = "counts") -> tuple[str, ...]:
    return (
        f"bl AS (SELECT label, CAST(sum(n) AS BIGINT) AS support, "
        f"CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS BIGINT) AS tp FROM {counts} GROUP BY label)",
        f"bp AS (SELECT prediction AS label, CAST(sum(n) AS BIGINT) AS predicted FROM {counts} GROUP BY prediction)",
        "pc0 AS (SELECT bl.label, support, tp, CAST(coalesce(predicted, 0) - tp AS BIGINT) AS fp, "
        "CAST(sum(support) OVER () AS BIGINT) AS total FROM bl LEFT JOIN bp ON bl.label = bp.label)",
        "pc1 AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS precision, "
        "CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) ELSE 0.0 END AS recall, "
        "CASE WHEN total - support > 0 THEN CAST(fp AS DOUBLE) / CAST(total - support AS DOUBLE) ELSE 0.0 END AS fpr FROM pc0)",
        "pc AS (SELECT label, support, tp, fp, precision, recall, "
        "CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, "
        "recall AS true_positive_rate, fpr AS false_positive_rate, total FROM pc1)",
    )


_q("confusion_matrix", "SELECT label, prediction, n FROM counts", *SCORED_CTES)
_q(
    "overall_metrics",
    "SELECT round(sum(tp) / sum(support), 10) AS accuracy, "
    "round(sum(precision * support) / sum(support), 10) AS weighted_precision, "
    "round(sum(recall * support) / sum(support), 10) AS weighted_recall, "
    "round(sum(f1 * support) / sum(support), 10) AS weighted_f1, "
    "round(sum(f1 * support) / sum(support), 10) AS f1, CAST(sum(support) AS BIGINT) AS n FROM pc",
    *SCORED_CTES,
    *_metric_ctes(),
)
_q(
    "per_class_metrics",
    "SELECT pc.*, coalesce(l.label_multi, CAST(pc.label AS VARCHAR)) AS label_name FROM pc "
    "LEFT JOIN lidx l ON pc.label = l.label_multi_idx",
    *SCORED_CTES,
    *_metric_ctes(),
)
_q("metrics_at_label", "SELECT * FROM pc WHERE label = 1.0", *SCORED_CTES, *_metric_ctes())
_q(
    "hard_auc",
    "SELECT round((true_positive_rate + 1.0 - false_positive_rate) / 2.0, 10) AS area_under_roc FROM pc WHERE label = 1.0",
    "bin AS (SELECT CASE WHEN label_multi = 'none' THEN 1.0 ELSE 0.0 END AS label, "
    "CASE WHEN rule_label = 'none' THEN 1.0 ELSE 0.0 END AS prediction FROM conn)",
    "bcounts AS (SELECT label, prediction, count(*) AS n FROM bin GROUP BY label, prediction)",
    *_metric_ctes("bcounts"),
)
MATRIX = "SELECT '[' || string_agg(line, ';  ' ORDER BY label) || ']' AS confusion_matrix FROM lines"
MATRIX_CTES = (
    "ls AS (SELECT DISTINCT label FROM counts)",
    "grid AS (SELECT t.label, p.label AS pred, coalesce(c.n, 0) AS n FROM ls t CROSS JOIN ls p "
    "LEFT JOIN counts c ON c.label = t.label AND c.prediction = p.label)",
    "lines AS (SELECT label, '[' || string_agg(CAST(n AS VARCHAR), ';' ORDER BY pred) || ']' AS line FROM grid GROUP BY label)",
)
_q("matrix_text", MATRIX, *SCORED_CTES, *MATRIX_CTES)


def _weighted(x: str) -> str:
    return f"round(sum({x}) / sum(support), 10)"


_q(
    "run_report",
    " UNION ALL ".join(
        [
            f"SELECT 'overall' AS section, '' AS label, '{m}' AS metric, printf('%.6f', {_weighted(x)}) AS value FROM pc"
            for m, x in {
                "accuracy": "tp",
                "weighted_precision": "precision * support",
                "weighted_recall": "recall * support",
                "weighted_f1": "f1 * support",
                "f1": "f1 * support",
            }.items()
        ]
        + [f"SELECT 'confusion', '', 'confusion_matrix', confusion_matrix FROM ({MATRIX})"]
        + [
            f"SELECT 'per_class', coalesce(l.label_multi, CAST(pc.label AS VARCHAR)), '{m}', printf('%.4f', {m}) "
            "FROM pc LEFT JOIN lidx l ON pc.label = l.label_multi_idx"
            for m in ("precision", "recall", "f1", "true_positive_rate", "false_positive_rate")
        ]
    ),
    *SCORED_CTES,
    *MATRIX_CTES,
    *_metric_ctes(),
)

# --- routing ---------------------------------------------------------------------

_q(
    "route_binary",
    "SELECT key, prediction, unnest(list_filter(['predictions', CASE WHEN prediction = 1.0 THEN 'benign' "
    "WHEN prediction = 0.0 THEN 'attack' END], lambda x: x IS NOT NULL)) AS topic FROM "
    "(SELECT key, CASE WHEN rule_label = 'none' THEN 1.0 ELSE 0.0 END AS prediction FROM conn)",
)
_q(
    "route_multiclass",
    "SELECT key, prediction, unnest(list_filter(['predictions', CASE WHEN prediction = 0.0 THEN 'benign' "
    "WHEN prediction <> 0.0 THEN 'attack' END], lambda x: x IS NOT NULL)) AS topic FROM scored",
    *SCORED_CTES,
)
_q(
    "route_by_name",
    "SELECT key, predicted_label, unnest(list_filter(['predictions', CASE WHEN predicted_label = 'none' THEN 'benign' "
    "WHEN predicted_label IS NOT NULL THEN 'attack' END], lambda x: x IS NOT NULL)) AS topic FROM "
    "(SELECT s.key, coalesce(l.label_multi, CAST(s.prediction AS VARCHAR)) AS predicted_label FROM scored s "
    "LEFT JOIN lidx l ON s.prediction = l.label_multi_idx)",
    *SCORED_CTES,
)
