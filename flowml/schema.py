"""Schemas, feature profiles and label maps of the flow-classification workflow.

Everything in the "fixed values" blocks must equal the workflow being matched
(public UNSW-NB15 flow layout and the connection-log JSON layout); it is stated
plainly, in natural order. Everything else is derived from those values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Raw labelled flow record, 49 columns, headerless CSV, in file order.
# --------------------------------------------------------------------------------------
RAW_FLOW_DDL = (
    "srcip string, sport int, dstip string, dsport int, proto string, state string, "
    "dur double, sbytes int, dbytes int, sttl int, dttl int, sloss int, dloss int, "
    "service string, Sload double, Dload double, Spkts int, Dpkts int, swin int, dwin int, "
    "stcpb double, dtcpb double, smeansz int, dmeansz int, trans_depth int, res_bdy_len int, "
    "Sjit double, Djit double, Stime int, Ltime int, Sintpkt double, Dintpkt double, "
    "tcprtt double, synack double, ackdat double, is_sm_ips_ports int, ct_state_ttl int, "
    "ct_flw_http_mthd int, is_ftp_login int, ct_ftp_cm int, ct_srv_src int, ct_srv_dst int, "
    "ct_dst_ltm int, ct_src_ltm int, ct_src_dport_ltm int, ct_dst_sport_ltm int, "
    "ct_dst_src_ltm int, attack_cat string, label int"
)

# Encoded (balanced) flow record, 10 columns, CSV with header.
ENCODED_FLOW_DDL = (
    "sport int, dsport int, proto_index double, dur double, sbytes int, dbytes int, "
    "service_index double, Spkts int, Dpkts int, attack_cat_index double"
)

# One connection-log JSON message (nested record plus envelope fields).
CONN_LOG_DDL = (
    "conn struct<ts: string, uid: string, `id.orig_h`: string, `id.orig_p`: int, "
    "`id.resp_h`: string, `id.resp_p`: int, proto: string, service: string, "
    "duration: double, orig_bytes: bigint, resp_bytes: bigint, conn_state: string, "
    "local_orig: boolean, local_resp: boolean, missed_bytes: string, history: string, "
    "orig_pkts: int, orig_ip_bytes: string, resp_pkts: int, resp_ip_bytes: string, "
    "tunnel_parents: string>, version string, type string, event string"
)

# Positional renaming target for the `conn` struct (same arity and order).
FLOW_FIXED_DDL = (
    "time string, uid string, srcip string, sport int, dstip string, dsport int, "
    "proto string, service string, dur double, sbytes bigint, dbytes bigint, state string, "
    "local_orig boolean, local_resp boolean, missed_bytes string, history string, "
    "Spkts int, orig_ip_bytes string, Dpkts int, resp_ip_bytes string, tunnel_parents string"
)

# Columns each feature profile keeps, string features, vector features.
ZEEK_KEEP = ["sport", "dsport", "proto", "dur", "sbytes", "dbytes", "service", "Spkts",
             "Dpkts", "attack_cat", "label"]
ARGUS_KEEP = ZEEK_KEEP + ["state", "sttl", "dttl", "sloss", "dloss", "Sload", "Dload"]
ZEEK_STRINGS = ["proto", "service", "attack_cat"]
ARGUS_STRINGS = ["proto", "state", "service", "attack_cat"]
ZEEK_VECTOR = ["sport", "dsport", "proto_index", "dur", "sbytes", "dbytes", "service_index",
               "Spkts", "Dpkts"]
ARGUS_VECTOR = ["sport", "dsport", "proto_index", "state_index", "dur", "sbytes", "dbytes",
                "service_index", "sttl", "dttl", "sloss", "dloss", "Sload", "Dload", "Spkts",
                "Dpkts"]

# Scoring subset of the renamed connection record, and the alert projection.
SCORING_COLUMNS = ["srcip", "sport", "dstip", "dsport", "proto", "dur", "sbytes", "dbytes",
                   "service", "Spkts", "Dpkts"]
ALERT_COLUMNS = ["prediction", "srcip", "sport", "dstip", "dsport", "proto", "proto_index",
                 "dur", "sbytes", "dbytes", "service_index", "Spkts", "Dpkts"]

# Label canonicalisation (exact whole-value replacements, attack_cat only).
CANONICAL_LABELS = {
    " Fuzzers ": " Fuzzers",
    " Shellcode ": "Shellcode",
    "Backdoor": "Backdoors",
    " Reconnaissance ": "Reconnaissance",
}

# Class index -> class name. Index 9 is the "keep" bucket (null label).
CLASS_NAMES = ["Generic", "Exploits", "Fuzzers", "DoS", "Reconnaissance", "Analysis",
               "Backdoors", "Shellcode", "Worms", "normal"]

# Model parameters of the workflow (decision tree / forest / MLP).
TREE_PARAMS = {"impurity": "entropy", "seed": 1234, "maxBins": 136, "maxDepth": 25}
SPLIT_WEIGHTS = (0.7, 0.3)
SPLIT_SEED = 1234
MLP_HIDDEN = [9, 9]


def ddl_to_struct(ddl: str) -> T.StructType:
    """Parse a DDL string into a StructType without a SparkSession."""
    return T._parse_datatype_string(ddl)  # noqa: SLF001 - public behaviour, private name


def ddl_columns(ddl: str) -> list[str]:
    return [f.name for f in ddl_to_struct(ddl).fields]


@dataclass(frozen=True)
class Profile:
    """Which raw columns a model sees: kept columns, string columns, vector inputs."""

    name: str
    keep: tuple[str, ...]
    strings: tuple[str, ...]
    vector: tuple[str, ...]

    @property
    def drop(self) -> list[str]:
        """Drop list = every raw column the profile does not keep."""
        return [c for c in ddl_columns(RAW_FLOW_DDL) if c not in self.keep]

    @property
    def width(self) -> int:
        return len(self.vector)


PROFILES = {
    "zeek": Profile("zeek", tuple(ZEEK_KEEP), tuple(ZEEK_STRINGS), tuple(ZEEK_VECTOR)),
    "argus": Profile("argus", tuple(ARGUS_KEEP), tuple(ARGUS_STRINGS), tuple(ARGUS_VECTOR)),
}


def class_map(normal_name: str = "normal") -> dict[str, str]:
    """Prediction decode map: "0.0" -> "Generic", ..., "9.0" -> ``normal_name``."""
    names = CLASS_NAMES[:-1] + [normal_name]
    return {f"{float(i)}": n for i, n in enumerate(names)}
