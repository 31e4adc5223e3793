"""Flow-shaped views over the supplied tables, for queries, tests and the bench.

Each view exists twice: as a DataFrame plan and as SQL text for the oracle.
Hash-friendly: every view column is a plain scalar (or an array of doubles).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.functions.scalars import class_index, lookup, round_to
from flowsieve.operators.triage import harmonize
from flowsieve.schemas import ACTIONS, CATEGORIES, SEVERITY

CLASSES = sorted(CATEGORIES)
NUMERIC = ["spkts", "sbytes", "rate", "dur", "dbytes", "smean", "sttl", "sload", "dttl"]
CATEGORICAL = ["proto", "service", "state"]
FEATURES = [*NUMERIC, *CATEGORICAL]
FLOW_COLUMNS = ["id", *CATEGORICAL, *NUMERIC, "label", "attack_cat", "split", "p"]

# Upper bounds of l_partkey % 100 per attack category: a skewed class mix.
_MIX = [(40, "Generic"), (65, "Exploits"), (80, "Fuzzers"), (90, "DoS"), (95, "Reconnaissance"),
        (97, "Analysis"), (98, "Backdoor"), (99, "Shellcode"), (100, "Worms")]
_EVENT_KIND = {"click": "Generic", "view": "Fuzzers", "error": "DoS", "purchase": "Reconnaissance", "signup": "Analysis"}


# ---- DataFrame plans --------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders, part = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part"))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))


def _attack_kind() -> Column:
    slot = F.col("l_partkey") % 100
    kind = F.when(slot < _MIX[0][0], _MIX[0][1])
    for bound, name in _MIX[1:]:
        kind = kind.when(slot < bound, name)
    return kind


def _flow_columns() -> list[Column]:
    normal = F.col("o_orderstatus") == "F"
    label = F.when(normal, 0).otherwise(1)
    score = round_to(label * F.lit(0.35) + 0.22 + F.col("l_quantity") * 0.45 / 50.0, 4)
    return [
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_returnflag").alias("proto"), F.col("p_brand").alias("service"), F.col("l_linestatus").alias("state"),
        F.col("l_quantity").alias("spkts"), F.col("l_extendedprice").alias("sbytes"),
        (F.col("l_discount") + 0.0).alias("rate"), (F.col("l_tax") + 0.0).alias("dur"),
        F.col("o_totalprice").alias("dbytes"), F.col("p_retailprice").alias("smean"),
        F.col("p_size").cast("double").alias("sttl"),
        (F.col("l_extendedprice") * 8 + F.col("l_quantity")).alias("sload"), F.lit(64.0).alias("dttl"),
        label.alias("label"), F.when(normal, "Normal").otherwise(_attack_kind()).alias("attack_cat"),
        F.when(F.col("l_orderkey") % 10 < 7, "train").otherwise("test").alias("split"),
        F.least(F.lit(1.0), score).alias("p"),
    ]


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled flows with a stage-one score ``p``."""
    return _joined(spark, sf_dir).select(*_flow_columns())


def splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    both = flows(spark, sf_dir)
    return both.filter("split = 'train'"), both.filter("split = 'test'")


def learnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows whose label and category follow three features, so that a model can be held to what it learns."""
    attack = (F.col("spkts") + F.col("sttl") > 50) | (F.col("proto") == "A")
    kind = (F.when(~attack, "Normal").when(F.col("proto") == "A", "Worms").when(F.col("sttl") > 40, "Generic")
            .when(F.col("sttl") > 25, "Exploits").otherwise("DoS"))
    return flows(spark, sf_dir).withColumns({"label": attack.cast("int"), "attack_cat": kind})


def learnable_splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    both = learnable(spark, sf_dir)
    return both.filter("split = 'train'"), both.filter("split = 'test'")


def probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows plus the class index ``y`` and ten class probabilities."""
    keys = [F.col("l_partkey").alias("_pk"), F.col("l_suppkey").alias("_sk")]
    base = _joined(spark, sf_dir).select(*_flow_columns(), *keys)
    base = base.withColumn("y", class_index(F.col("attack_cat"), CLASSES))
    raw = F.array(*[
        (1 + (F.col("_pk") * (7 + i) + F.col("_sk") * i) % 97 + F.when(F.col("y") == i, 60).otherwise(0)).cast("double")
        for i in range(len(CLASSES))
    ])

    def shares(values: Column) -> Column:
        return F.transform(values, lambda v: v / F.aggregate(values, F.lit(0.0), lambda a, b: a + b))

    # The array is bound once; spelled out per share it would outgrow the code a JVM method may hold.
    return base.withColumn("probs", F.element_at(F.transform(F.array(raw), shares), 1)).drop("_pk", "_sk")


def flows_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows as they arrive: gaps, infinities, padded text, text labels, an alias name."""
    c = F.col
    kind = (
        F.when((c("label") == 0) & (c("spkts") % 3 == 0), " Generic ")
        .when((c("attack_cat") == "Backdoor") & (c("split") == "test"), "Backdoors").otherwise(c("attack_cat"))
    )
    return flows(spark, sf_dir).select(
        "id", F.concat(F.lit("  "), "proto", F.lit("\t")).alias("proto"),
        F.when(c("spkts") != 21, c("service")).alias("service"), "state",
        F.nullif(c("spkts"), F.lit(13.0)).alias("spkts"),
        F.when(c("spkts") == 7, float("inf")).when(c("spkts") == 8, float("-inf")).otherwise(c("sbytes")).alias("sbytes"),
        "rate", "dur", F.when(c("spkts") % 2 == 0, c("label").cast("string")).otherwise(
            F.concat(c("label").cast("string"), F.lit(".0"))).alias("label"),
        kind.alias("attack_cat"), "split",
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert events over the event table; missing fields come from harmonisation."""
    return alerts_of(table(spark, sf_dir, "events"))


def alerts_of(events: DataFrame) -> DataFrame:
    """The projection behind :func:`alerts`; works on a stream as well."""
    p = round_to(F.least(F.col("value") / 100, F.lit(1.0)), 4)
    attack = p >= 0.8
    partial = events.select(
        F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        attack.alias("is_attack"), F.when(attack, lookup(_EVENT_KIND, F.col("event_type"), None)).alias("attack_category"),
        p.alias("binary_probability"),
        F.when(attack, round_to(0.5 + F.col("event_id") % 50 / 100, 4)).alias("multi_confidence"),
        F.lit("1.0.0").alias("model_version"), F.col("event_id").alias("record_index"),
    )
    return harmonize(partial)


# ---- SQL text for the oracle ------------------------------------------------


def _case(key: str, mapping: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {key} {arms} ELSE {default} END"


_MIX_SQL = "CASE " + " ".join(f"WHEN l_partkey % 100 < {b} THEN '{n}'" for b, n in _MIX) + " END"
_RAW_SQL = ", ".join(
    f"CAST(1 + (l_partkey * {7 + i} + l_suppkey * {i}) % 97 + CASE WHEN attack_cat = '{c}' THEN 60 ELSE 0 END AS DOUBLE)"
    for i, c in enumerate(CLASSES))
CLASS_LIST_SQL = "[" + ", ".join(f"'{c}'" for c in CLASSES) + "]"

VIEWS = {
    "base": f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
       l_returnflag AS proto, p_brand AS service, l_linestatus AS state, l_quantity AS spkts,
       l_extendedprice AS sbytes, l_discount + 0.0 AS rate, l_tax + 0.0 AS dur, o_totalprice AS dbytes,
       p_retailprice AS smean, CAST(p_size AS DOUBLE) AS sttl, l_extendedprice * 8 + l_quantity AS sload,
       CAST(64 AS DOUBLE) AS dttl,
       CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS label,
       CASE WHEN o_orderstatus = 'F' THEN 'Normal' ELSE {_MIX_SQL} END AS attack_cat,
       CASE WHEN l_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split,
       least(CAST(1 AS DOUBLE), round(CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS DOUBLE) ELSE CAST(0.35 AS DOUBLE) END
             + CAST(0.22 AS DOUBLE) + l_quantity * CAST(0.45 AS DOUBLE) / 50, 4)) AS p,
       l_partkey, l_suppkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "flows": f"SELECT {', '.join(FLOW_COLUMNS)} FROM base",
    "probs": f"""
SELECT {', '.join(FLOW_COLUMNS)}, list_position({CLASS_LIST_SQL}, attack_cat) - 1 AS y,
       list_transform(raw, lambda v: v / list_sum(raw)) AS probs
FROM (SELECT *, [{_RAW_SQL}] AS raw FROM base)""",
    "learnable": """
SELECT * REPLACE (CASE WHEN spkts + sttl > 50 OR proto = 'A' THEN 1 ELSE 0 END AS label,
                  CASE WHEN NOT (spkts + sttl > 50 OR proto = 'A') THEN 'Normal' WHEN proto = 'A' THEN 'Worms' WHEN sttl > 40 THEN 'Generic'
                       WHEN sttl > 25 THEN 'Exploits' ELSE 'DoS' END AS attack_cat) FROM flows""",
    "learnable_train": "SELECT * FROM learnable WHERE split = 'train'",
    "learnable_test": "SELECT * FROM learnable WHERE split = 'test'",
    "train": "SELECT * FROM flows WHERE split = 'train'",
    "test": "SELECT * FROM flows WHERE split = 'test'",
    "flows_dirty": """
SELECT id, '  ' || proto || chr(9) AS proto, CASE WHEN spkts <> 21 THEN service END AS service, state,
       nullif(spkts, 13) AS spkts,
       CASE WHEN spkts = 7 THEN CAST('inf' AS DOUBLE) WHEN spkts = 8 THEN CAST('-inf' AS DOUBLE) ELSE sbytes END AS sbytes,
       rate, dur, CASE WHEN spkts % 2 = 0 THEN CAST(label AS VARCHAR) ELSE label || '.0' END AS label,
       CASE WHEN label = 0 AND spkts % 3 = 0 THEN ' Generic '
            WHEN attack_cat = 'Backdoor' AND split = 'test' THEN 'Backdoors' ELSE attack_cat END AS attack_cat, split
FROM flows""",
    "cleaned": """
SELECT id, regexp_replace(proto, '^\\s+|\\s+$', '', 'g') AS proto, service, state, spkts,
       CASE WHEN isinf(sbytes) THEN NULL ELSE sbytes END AS sbytes, rate, dur,
       CAST(CAST(label AS DOUBLE) AS INTEGER) AS label,
       CASE WHEN CAST(label AS DOUBLE) = 0 THEN 'Normal'
            WHEN attack_cat = 'Backdoors' AND split = 'test' THEN 'Backdoor' ELSE trim(attack_cat) END AS attack_cat, split
FROM flows_dirty""",
    "alert_base": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS timestamp,
       round(least(value / 100, 1), 4) AS bp, event_id AS record_index,
       {_case('event_type', _EVENT_KIND, 'NULL')} AS kind,
       round(0.5 + CAST(event_id % 50 AS DOUBLE) / 100, 4) AS mp
FROM events""",
    "alerts": f"""
SELECT event_id, timestamp, CASE WHEN bp >= 0.8 THEN 'Attack' ELSE 'Normal' END AS prediction,
       CASE WHEN bp >= 0.8 THEN kind ELSE 'Normal' END AS attack_type, bp AS binary_probability,
       CAST(0.8 AS DOUBLE) AS binary_threshold,
       CASE WHEN bp >= 0.8 THEN bp ELSE round(1 - bp, 4) END AS binary_confidence,
       CASE WHEN bp >= 0.8 THEN mp END AS multiclass_probability,
       CASE WHEN bp >= 0.8 THEN mp ELSE round(1 - bp, 4) END AS confidence,
       CASE WHEN bp >= 0.8 THEN {_case('kind', SEVERITY, "'Critical'")} ELSE 'None' END AS severity,
       CASE WHEN bp >= 0.8 THEN {_case('kind', ACTIONS, "''")} ELSE '{ACTIONS['Normal']}' END AS recommended_action,
       '1.0.0' AS model_version, record_index
FROM alert_base""",
}
_NEEDS = {
    "base": [], "flows": ["base"], "probs": ["base"], "train": ["flows"], "test": ["flows"],
    "learnable": ["flows"], "learnable_train": ["learnable"], "learnable_test": ["learnable"],
    "flows_dirty": ["flows"], "cleaned": ["flows_dirty"], "alert_base": [], "alerts": ["alert_base"],
}


def sql(body: str, *views: str, **extra: str) -> str:
    """``body`` with the named views (and their inputs) and extra CTEs in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in _NEEDS[name]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    parts = [f"{n} AS ({VIEWS[n]})" for n in ordered] + [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
