"""DuckDB SQL for the model queries whose training SQL can repeat."""

from __future__ import annotations

from .. import config as C
from ..operators.forest import exact_tree_sql
from .oracle import SQL
from .oracle_more import F12_NUMERIC, QUANTILE_BINS_CTES, quantile_bins_body
from .queries_models import TREE_DEPTH
from .sql_conn import hash_bucket_sql, with_conn

_BINS = [f"{c}_bin" for c in F12_NUMERIC]
_TRAIN = f"{hash_bucket_sql('key', 1000, 'split|')} < {round(C.EVAL_TRAIN_FRACTION * 1000)}"

SQL["tree_scored"] = exact_tree_sql(
    "binned",
    _BINS,
    TREE_DEPTH,
    f"bins AS ({with_conn(quantile_bins_body('label_multi'), *QUANTILE_BINS_CTES)}),\n"
    f"binned AS (SELECT *, {_TRAIN} AS train, CASE WHEN label_multi = '{C.BENIGN_LABEL}' THEN 1 ELSE 0 END AS y FROM bins)",
)
