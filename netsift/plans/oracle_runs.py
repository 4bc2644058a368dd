"""DuckDB SQL for the queries of stored statistics, recorded runs and the CSV replay."""

from __future__ import annotations

from .. import config as C
from .oracle import BOOLS, NUMERIC, PORTS, SQL, TEXT
from .oracle_more import CLEAN_CTE, F12_NUMERIC
from .queries_runs import SKETCH_PROBS
from .sql_conn import hash_bucket_sql, with_conn

_TRAIN = f"{hash_bucket_sql('key', 1000, 'split|')} < {round(C.EVAL_TRAIN_FRACTION * 1000)}"

SQL["sketched_quantiles"] = with_conn(
    f"SELECT f.feature, p.p, (SELECT count(*) FROM cf) AS n, true AS within_error "
    f"FROM (SELECT unnest({F12_NUMERIC}) AS feature) f, (SELECT unnest({list(SKETCH_PROBS)})::DOUBLE AS p) p",
    CLEAN_CTE,
)
SQL["sketched_distinct"] = (
    f"SELECT d.feature, d.n_distinct, true AS within_error, (SELECT count(*) FROM lineitem) AS n_rows FROM ({SQL['distinct_per_feature']}) d"
)
SQL["run_summary"] = (
    f"WITH m AS ({SQL['overall_metrics']}), c AS ({SQL['row_counts']}) "
    f"SELECT 'r3' AS run_id, 'rule' AS experiment, {len(C.F12_FEATURES)} AS num_features, '{','.join(C.F12_FEATURES)}' AS features, "
    "m.*, NULL::BIGINT AS n_rows, NULL::BIGINT AS n_train, NULL::BIGINT AS n_test FROM m UNION ALL BY NAME "
    "SELECT 'r1' AS run_id, 'counts' AS experiment, c.n_rows, c.n_train, c.n_test FROM c"
)
SQL["stage_rows"] = with_conn(
    "SELECT 0 AS position, 'load' AS stage, count(*) AS rows FROM conn UNION ALL SELECT 1, 'binning', count(*) FROM cf "
    f"UNION ALL SELECT 2, 'training', NULL UNION ALL SELECT 3, 'prediction', count(*) FROM cf WHERE NOT ({_TRAIN})",
    CLEAN_CTE,
)
SQL["csv_replay"] = with_conn(
    "SELECT key, "
    + ", ".join(f"coalesce(TRY_CAST({c} AS DOUBLE), 0.0) AS {c}" for c in NUMERIC + PORTS)
    + ", "
    + ", ".join(f"coalesce(lower(trim({c})) IN ('true', '1', 'yes'), false) AS {c}" for c in BOOLS)
    + ", false AS corrupt FROM text UNION ALL SELECT key, "
    + ", ".join("0.0::DOUBLE" for _ in NUMERIC + PORTS)
    + ", false, false, true FROM conn WHERE _ok % 97 = 0",
    TEXT,
)
