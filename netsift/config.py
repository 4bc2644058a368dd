"""Column roles, feature presets and the fixed values every operator shares.

Operators take a :class:`Roles` (or a preset name) instead of hard-coding
column names, so the same code serves the stream schema, the raw Zeek-named
tables and the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They must stay equal to the reference application's for the
# results to match: label names, topic names, rename maps, feature lists,
# model parameters and seeds.
# ---------------------------------------------------------------------------

BENIGN_LABEL = "none"
LABEL_COL = "label_multi"

CATEGORICAL_COLS = ("protocol", "conn_state", "history", "service")
NUMERIC_COLS = (
    "duration",
    "orig_bytes",
    "orig_pkts",
    "orig_ip_bytes",
    "resp_bytes",
    "resp_pkts",
    "resp_ip_bytes",
    "missed_bytes",
)
BOOLEAN_COLS = ("local_orig", "local_resp")
IP_COLS = ("src_ip", "dest_ip")
PORT_COLS = ("src_port", "dest_port")

# 12-attribute preset and the columns the 12-attribute loader drops.
F12_FEATURES = (
    "src_port",
    "dest_port",
    "protocol",
    "conn_state",
    "orig_bytes",
    "orig_pkts",
    "orig_ip_bytes",
    "resp_bytes",
    "resp_pkts",
    "resp_ip_bytes",
    "missed_bytes",
    "local_resp",
)
F12_DROP = (
    "src_ip",
    "dest_ip",
    "uid",
    "community_id",
    "local_orig",
    "ts",
    "service",
    "datetime",
    "history",
    "duration",
)

# 18 binned attributes in rank order; sweeps use the first 18 / 12 / 9 / 6.
F18_RANKED = (
    "history_bin",
    "protocol_bin",
    "service_bin",
    "orig_bytes_bin",
    "dest_ip_bin",
    "orig_pkts_bin",
    "orig_ip_bytes_bin",
    "local_resp_bin",
    "dest_port_bin",
    "duration_bin",
    "conn_state_bin",
    "resp_pkts_bin",
    "resp_ip_bytes_bin",
    "src_port_bin",
    "resp_bytes_bin",
    "src_ip_bin",
    "local_orig_bin",
    "missed_bytes_bin",
)
SWEEP_SIZES = (18, 12, 9, 6)

# Strict rename map of raw Zeek names (every key must exist).
STRICT_RENAME = {
    "label_tactic": "label_multi",
    "service": "service",
    "orig_ip_bytes": "orig_ip_bytes",
    "local_resp": "local_resp",
    "missed_bytes": "missed_bytes",
    "proto": "protocol",
    "duration": "duration",
    "conn_state": "conn_state",
    "dest_ip_zeek": "dest_ip",
    "orig_pkts": "orig_pkts",
    "community_id": "community_id",
    "resp_ip_bytes": "resp_ip_bytes",
    "dest_port_zeek": "dest_port",
    "orig_bytes": "orig_bytes",
    "local_orig": "local_orig",
    "datetime": "datetime",
    "history": "history",
    "resp_bytes": "resp_bytes",
    "uid": "uid",
    "src_port_zeek": "src_port",
    "ts": "ts",
    "src_ip_zeek": "src_ip",
}
# Tolerant rename map (absent names are skipped) and label fallbacks in order.
TOLERANT_RENAME = {
    "proto": "protocol",
    "src_port_zeek": "src_port",
    "dest_port_zeek": "dest_port",
    "src_ip_zeek": "src_ip",
    "dest_ip_zeek": "dest_ip",
}
LABEL_FALLBACKS = ("label_tactic", "label_technique", "label_binary", "label_cve")

# Streaming topics and the output projection of the scorer.
TOPIC_PREDICTIONS = "predictions"
TOPIC_BENIGN = "benign"
TOPIC_ATTACK = "attack"
TOPIC_DEADLETTER = "deadletter"
OUTPUT_COLS = (
    "src_ip",
    "dest_ip",
    "src_port",
    "dest_port",
    "protocol",
    "conn_state",
    "label_multi",
    "predicted_label",
    "prediction",
)

# Wire coercion: a boolean is true iff its trimmed lower-case text is one of these.
WIRE_TRUE = ("true", "1", "yes")

# Model parameters and seeds.
RANDOM_SEED = 2057
SAMPLE_SEED = 1234
RF_BINARY = {"numTrees": 20, "maxDepth": 10}
RF_MULTICLASS = {"numTrees": 10, "maxDepth": 10}
QUANTILE_BUCKETS_F16 = 32
QUANTILE_BUCKETS_F12 = 8
TRAIN_FRACTION = 0.8
EVAL_TRAIN_FRACTION = 0.7
ATTACK_SHARE = 0.3
TOP_K_LABELS = 10
MIN_SLICE_ROWS = 500
ALL_LABELS_SLICE = "All label techniques"
NOMINAL_SHARE = 0.98
NUMERIC_TRIM = 0.02

# Delivery and fetch batching.
FETCH_BATCH_SIZE = 1000
PUBLISH_BATCH_SIZE = 1000

# Synthetic generator: label weights and attack labels.
SYNTHETIC_ATTACK_LABELS = tuple(f"T{1000 + i}" for i in range(10))
SYNTHETIC_BENIGN_RATIO = 0.6

# Default relative error of the quantile sketch (Spark ML's default).
QUANTILE_RELATIVE_ERROR = 0.001


@dataclass(frozen=True)
class Roles:
    """Which column plays which part. Every operator reads roles from here."""

    categorical: tuple[str, ...] = CATEGORICAL_COLS
    numeric: tuple[str, ...] = NUMERIC_COLS
    boolean: tuple[str, ...] = BOOLEAN_COLS
    ip: tuple[str, ...] = IP_COLS
    port: tuple[str, ...] = PORT_COLS
    label: str = LABEL_COL
    benign: str = BENIGN_LABEL
    extra: tuple[str, ...] = field(default_factory=tuple)

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric + self.port + self.boolean


DEFAULT_ROLES = Roles()

PRESETS: dict[str, tuple[str, ...]] = {
    "f16": CATEGORICAL_COLS + NUMERIC_COLS + PORT_COLS + BOOLEAN_COLS,
    "f12": F12_FEATURES,
    "f18": F18_RANKED,
}


def conn_schema() -> T.StructType:
    """Fixed schema of one connection record on the wire."""
    d, s, b = T.DoubleType(), T.StringType(), T.BooleanType()
    fields = [
        ("src_ip", s),
        ("dest_ip", s),
        ("src_port", d),
        ("dest_port", d),
        ("protocol", s),
        ("conn_state", s),
        ("service", s),
        ("history", s),
        ("duration", d),
        ("orig_bytes", d),
        ("orig_pkts", d),
        ("orig_ip_bytes", d),
        ("resp_bytes", d),
        ("resp_pkts", d),
        ("resp_ip_bytes", d),
        ("missed_bytes", d),
        ("local_orig", b),
        ("local_resp", b),
        ("label_multi", s),
    ]
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CONN_COLUMNS = tuple(f.name for f in conn_schema().fields)
