"""Registered queries: sources, sinks, cleaning, validation, profiling, exploration, sampling, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.functions.scalars import class_name, round_to
from flowsieve.functions.scale import materialize, stored
from flowsieve.operators import (
    alerts as al, cleaning, exploration as ex, profiling as pr, sampling as sa, triage as tr, validation as va,
)
from flowsieve.plans.catalog import query
from flowsieve.plans.views import CATEGORICAL, CLASS_LIST_SQL, CLASSES, FEATURES, NUMERIC, alerts, flows, flows_dirty, probs, splits, sql, table
from flowsieve.schemas import ACTIONS, DEFAULT_ACTION, SCENARIO_QUOTAS, SEVERITY, triage_dimension
from flowsieve.session import scratch_path
from flowsieve.sources import readers, writers

# ---- sources and sinks ------------------------------------------------------

_CSV_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CATEGORICAL]
    + [T.StructField(c, T.DoubleType()) for c in NUMERIC]
    + [T.StructField("label", T.IntegerType()), T.StructField("attack_cat", T.StringType())]
)


@query("scan_csv", sql(f"SELECT {', '.join(f.name for f in _CSV_SCHEMA.fields)} FROM flows", "flows"))
def _scan_csv(spark, sf):
    path = scratch_path(spark, "csv")
    # The file has its own column order; columns are found by their header names.
    flows(spark, sf).select(*[f.name for f in reversed(_CSV_SCHEMA.fields)]).write.csv(path, header=True)
    return readers.read_csv(spark, path, _CSV_SCHEMA)


@query("scenario_head", sql("SELECT id, proto, attack_cat, p FROM test ORDER BY id LIMIT 500", "test"))
def _scenario_head(spark, sf):
    return readers.head(splits(spark, sf)[1], ["id"], 500).select("id", "proto", "attack_cat", "p")


@query("record_index", sql("SELECT event_id, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS record_index FROM events"))
def _record_index(spark, sf):
    return readers.with_record_index(table(spark, sf, "events"), ["user_id", "ts", "event_id"]).select("event_id", "record_index")


@query("file_manifest")
def _file_manifest(spark, sf):
    return readers.file_manifest(spark, sf, "*.parquet").select("file_name", "size_bytes", "size_mb", "sha256")


@query("list_sources")
def _list_sources(spark, sf):
    return readers.list_sources(spark, sf)


@query("upsert_latest", sql("""
SELECT event_id, CASE WHEN record_index % 3 = 0 THEN round(1 - confidence, 4) ELSE confidence END AS confidence,
       CASE WHEN record_index % 3 = 0 THEN '1.0.1' ELSE model_version END AS model_version, record_index
FROM alerts""", "alerts"))
def _upsert_latest(spark, sf):
    events, path = alerts(spark, sf), scratch_path(spark, "keyed")
    changed = events.filter("record_index % 3 = 0").withColumns(
        {"confidence": round_to(1 - F.col("confidence"), 4), "model_version": F.lit("1.0.1")})
    writers.upsert_events(events, path, 0)
    writers.upsert_events(changed, path, 1)
    return writers.read_events(spark, path).select("event_id", "confidence", "model_version", "record_index")


_SUMMARY = """
SELECT count(*) AS total, count(*) FILTER (prediction = 'Normal') AS normal,
       count(*) FILTER (prediction = 'Attack') AS attacks, count(*) FILTER (severity = 'Critical') AS critical,
       coalesce(avg(confidence), 0) AS avg_confidence,
       CASE WHEN count(*) = 0 THEN '—' WHEN count(*) FILTER (severity = 'Critical') > 0 THEN 'Critical'
            WHEN count(*) FILTER (severity = 'High') > 0 THEN 'High'
            WHEN count(*) FILTER (prediction = 'Attack') > 0 THEN 'Medium' ELSE 'Normal' END AS risk_level
FROM alerts"""


@query("summary_unpivot", sql("""
SELECT 'total' AS metric, CAST(total AS VARCHAR) AS value FROM s UNION ALL
SELECT 'normal', CAST(normal AS VARCHAR) FROM s UNION ALL SELECT 'attacks', CAST(attacks AS VARCHAR) FROM s UNION ALL
SELECT 'critical', CAST(critical AS VARCHAR) FROM s UNION ALL
SELECT 'avg_confidence', printf('%.4f', avg_confidence) FROM s UNION ALL SELECT 'risk_level', risk_level FROM s
""", "alerts", s=_SUMMARY))
def _summary_unpivot(spark, sf):
    return al.summary_rows(alerts(spark, sf))


# ---- projections ------------------------------------------------------------


@query("project_features", sql(f"SELECT {', '.join(FEATURES)} FROM flows", "flows"))
def _project_features(spark, sf):
    return cleaning.project_features(flows(spark, sf), ["id", "label", "attack_cat", "split", "p"])


@query("strip_ground_truth", sql(f"SELECT id, {', '.join(FEATURES)} FROM flows", "flows"))
def _strip_ground_truth(spark, sf):
    return va.strip_ground_truth(flows(spark, sf), FEATURES, keep=["id", "label"])


_OUT = ("event_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, prediction, attack_type, binary_probability, "
        "binary_threshold, binary_confidence, multiclass_probability, confidence, severity, recommended_action, "
        "model_version, record_index")


@query("alert_projection", sql(f"SELECT {_OUT} FROM alerts", "alerts"))
def _alert_projection(spark, sf):
    return va.output_projection(alerts(spark, sf)).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("display_projection", sql("SELECT event_id, prediction, confidence FROM alerts", "alerts"))
def _display_projection(spark, sf):
    partial = alerts(spark, sf).select("event_id", "prediction", "confidence", "is_attack", F.lit(1).alias("label"))
    return va.display_projection(partial)


@query("downcast_float", sql("""
SELECT id, round(CAST(CAST(sbytes AS FLOAT) AS DOUBLE), 4) AS sbytes, round(CAST(CAST(p AS FLOAT) AS DOUBLE), 6) AS p
FROM flows""", "flows"))
def _downcast(spark, sf):
    from flowsieve.operators.features import downcast

    narrow = downcast(flows(spark, sf).select("id", "sbytes", "p"), ["sbytes", "p"])
    return narrow.select("id", round_to(F.col("sbytes").cast("double"), 4).alias("sbytes"), round_to(F.col("p").cast("double"), 6).alias("p"))


@query("schema_diff")
def _schema_diff(spark, sf):
    right = flows(spark, sf).drop("p").withColumn("spkts", F.col("spkts").cast("long"))
    return pr.schema_diff(flows(spark, sf), right.select(*right.columns[1:], "id"))


# ---- cleaning ---------------------------------------------------------------


@query("clean_inf", sql("SELECT id, spkts, CASE WHEN isinf(sbytes) THEN NULL ELSE sbytes END AS sbytes FROM flows_dirty", "flows_dirty"))
def _clean_inf(spark, sf):
    return cleaning.clean_infinities(flows_dirty(spark, sf)).select("id", "spkts", "sbytes")


@query("clean_trim", sql("""
SELECT id, regexp_replace(proto, '^\\s+|\\s+$', '', 'g') AS proto, service, trim(attack_cat) AS attack_cat, label
FROM flows_dirty""", "flows_dirty"))
def _clean_trim(spark, sf):
    return cleaning.clean_strings(flows_dirty(spark, sf)).select("id", "proto", "service", "attack_cat", "label")


@query("clean_null_token", sql("SELECT id, coalesce(service, 'nan') AS service FROM flows_dirty", "flows_dirty"))
def _clean_null_token(spark, sf):
    return cleaning.clean_strings(flows_dirty(spark, sf), null_token="nan").select("id", "service")


@query("label_domain", sql("""
SELECT count(*) AS n_rows, count(*) FILTER (v = 0) AS n_normal, count(*) FILTER (v = 1) AS n_attack,
       count(*) FILTER (v IS NULL OR v NOT IN (0, 1)) AS n_invalid
FROM (SELECT TRY_CAST(CASE WHEN spkts = 5 THEN 'x' WHEN spkts = 6 THEN '2' ELSE label END AS DOUBLE) AS v FROM flows_dirty)
""", "flows_dirty"))
def _label_domain(spark, sf):
    odd = F.when(F.col("spkts") == 5, "x").when(F.col("spkts") == 6, "2").otherwise(F.col("label"))
    return cleaning.label_violations(flows_dirty(spark, sf).withColumn("label", odd))


@query("clean_label", sql("SELECT id, CAST(CAST(label AS DOUBLE) AS INTEGER) AS label FROM flows_dirty", "flows_dirty"))
def _clean_label(spark, sf):
    return cleaning.clean_label(flows_dirty(spark, sf)).select("id", "label")


@query("clean_category", sql("""
SELECT id, CASE WHEN CAST(label AS DOUBLE) = 0 THEN 'Normal' ELSE attack_cat END AS attack_cat FROM flows_dirty""", "flows_dirty"))
def _clean_category(spark, sf):
    return cleaning.clean_category(cleaning.clean_label(flows_dirty(spark, sf))).select("id", "attack_cat")


@query("clean_rename", sql("""
SELECT id, split, CASE WHEN attack_cat = 'Backdoors' AND NOT h.has THEN 'Backdoor' ELSE attack_cat END AS attack_cat
FROM flows_dirty JOIN h USING (split)""", "flows_dirty",
    h="SELECT split, bool_or(attack_cat = 'Backdoor') AS has FROM flows_dirty GROUP BY split"))
def _clean_rename(spark, sf):
    return cleaning.rename_alias(flows_dirty(spark, sf), by="split").select("id", "split", "attack_cat")


@query("row_guard", sql("SELECT count(*) AS rows_in, count(*) AS rows_out, true AS preserved FROM flows_dirty", "flows_dirty"))
def _row_guard(spark, sf):
    raw = flows_dirty(spark, sf)
    return cleaning.row_guard(raw, cleaning.clean_split(raw, by="split"))


@query("clean_split", sql("SELECT * FROM cleaned", "cleaned"))
def _clean_split(spark, sf):
    return cleaning.clean_split(flows_dirty(spark, sf), by="split")


# ---- validation -------------------------------------------------------------


def _text_rows(spark, sf):
    odd = F.when(F.col("spkts") % 10 == 0, "abc").when(F.col("spkts") % 10 == 1, "").when(
        F.col("spkts") % 10 == 2, None).otherwise("12.5")
    return flows(spark, sf).select("id", odd.alias("spkts"), F.when(F.col("sttl") != 7, F.lit("9")).alias("sttl"))


_TEXT = """
SELECT id, concat_ws(',', CASE WHEN sttl = 7 THEN 'missing:sttl' END,
                          CASE WHEN spkts % 10 = 0 THEN 'not_numeric:spkts' END) AS reasons FROM flows"""


@query("validate_rows", sql("SELECT id, reasons FROM v", "flows", v=_TEXT))
def _validate_rows(spark, sf):
    checked = va.validate_rows(_text_rows(spark, sf), ["spkts", "sttl"], required=["sttl"])
    return checked.select("id", F.array_join(va.REASONS, ",").alias("reasons"))


@query("quarantine", sql("""
SELECT reason, count(*) AS n_rows FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM v WHERE reasons <> '')
GROUP BY reason""", "flows", v=_TEXT))
def _quarantine(spark, sf):
    return va.quarantine_counts(va.validate_rows(_text_rows(spark, sf), ["spkts", "sttl"], required=["sttl"]))


@query("accepted_rows", sql("SELECT id FROM v WHERE reasons = ''", "flows", v=_TEXT))
def _accepted_rows(spark, sf):
    checked = va.validate_rows(_text_rows(spark, sf), ["spkts", "sttl"], required=["sttl"])
    return va.apply_policy(checked, "quarantine").select("id")


@query("validate_domain", sql("""
SELECT id, lower(trim(proto)) AS proto, concat_ws(',', CASE WHEN sport NOT BETWEEN 0 AND 65535 THEN 'port:sport' END,
    CASE WHEN dur < 0 THEN 'negative:dur' END, CASE WHEN label > 1 THEN 'label:label' END) AS reasons
FROM (SELECT id, '  ' || proto || ' ' AS proto, CAST(spkts * 1500 - 3000 AS INTEGER) AS sport, rate - 0.02 AS dur,
             CASE WHEN spkts = 3 THEN 2 ELSE label END AS label FROM flows)""", "flows"))
def _validate_domain(spark, sf):
    rows = flows(spark, sf).select(
        "id", F.concat(F.lit("  "), "proto", F.lit(" ")).alias("proto"),
        (F.col("spkts") * 1500 - 3000).cast("int").alias("sport"), (F.col("rate") - 0.02).alias("dur"),
        F.when(F.col("spkts") == 3, 2).otherwise(F.col("label")).alias("label"))
    return va.validate_domain(rows).select("id", "proto", F.array_join(va.REASONS, ",").alias("reasons"))


@query("validate_probs", sql("""
SELECT id, round(q, 4) AS q, CASE WHEN round(q, 4) NOT BETWEEN 0 AND 1 THEN 'range:q' ELSE '' END AS reasons
FROM (SELECT id, p * 1.5 - CAST(0.4 AS DOUBLE) AS q FROM flows)""", "flows"))
def _validate_probs(spark, sf):
    checked = va.validate_probabilities(flows(spark, sf).select("id", (F.col("p") * 1.5 - 0.4).alias("q")), ["q"])
    return checked.select("id", "q", F.array_join(va.REASONS, ",").alias("reasons"))


@query("attack_only", sql("SELECT id, attack_cat FROM flows WHERE label = 1", "flows"))
def _attack_only(spark, sf):
    return va.attack_only(flows(spark, sf)).select("id", "attack_cat")


# ---- joins and set operations ----------------------------------------------

_KEYS = ["proto", "service", "state", "spkts"]


@query("split_overlap", sql("""
SELECT count(*) AS overlapping_patterns, CAST(4 AS BIGINT) AS compared_columns FROM (
SELECT proto, service, state, spkts FROM train INTERSECT SELECT proto, service, state, spkts FROM test)""", "train", "test"))
def _split_overlap(spark, sf):
    train, test = splits(spark, sf)
    return pr.split_overlap(train.select("id", *_KEYS), test.select("id", *_KEYS))


@query("target_compare", sql("""
SELECT attack_cat, count(*) FILTER (split = 'train') AS train_count,
       round(count(*) FILTER (split = 'train') * 100.0::DOUBLE / (SELECT count(*) FROM train), 3) AS train_pct,
       count(*) FILTER (split = 'test') AS test_count,
       round(count(*) FILTER (split = 'test') * 100.0::DOUBLE / (SELECT count(*) FROM test), 3) AS test_pct
FROM flows GROUP BY attack_cat""", "train", "test"))
def _target_compare(spark, sf):
    return ex.target_compare(*splits(spark, sf))


@query("binary_balance", sql("""
SELECT label, count(*) FILTER (split = 'train') AS train_count,
       round(count(*) FILTER (split = 'train') * 100.0::DOUBLE / (SELECT count(*) FROM train), 2) AS train_pct,
       count(*) FILTER (split = 'test') AS test_count,
       round(count(*) FILTER (split = 'test') * 100.0::DOUBLE / (SELECT count(*) FROM test), 2) AS test_pct
FROM flows GROUP BY label""", "train", "test"))
def _binary_balance(spark, sf):
    return ex.binary_balance(*splits(spark, sf))


@query("topk_compare", sql("""
SELECT t.service, t.n AS train_count, count(x.id) AS test_count
FROM (SELECT service, count(*) AS n FROM train GROUP BY service ORDER BY n DESC, service LIMIT 8) t
LEFT JOIN test x ON x.service = t.service GROUP BY t.service, t.n""", "train", "test"))
def _topk_compare(spark, sf):
    return ex.topk_compare(*splits(spark, sf), "service", 8)


def _case(key, mapping, default):
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE '{default}' END"


@query("triage_lookup", sql(f"""
SELECT id, attack_type, {_case('attack_type', SEVERITY, 'Critical')} AS severity,
       {_case('attack_type', ACTIONS, DEFAULT_ACTION)} AS recommended_action
FROM (SELECT id, CASE WHEN spkts = 50 THEN 'Unlisted' ELSE attack_cat END AS attack_type FROM flows)""", "flows"))
def _triage_lookup(spark, sf):
    rows = flows(spark, sf).select("id", F.when(F.col("spkts") == 50, "Unlisted").otherwise(F.col("attack_cat")).alias("attack_type"))
    return tr.triage_lookup(rows, triage_dimension(spark))


@query("domain_shift", sql("""
SELECT coalesce(a.column_name, b.column_name) AS column_name, coalesce(a.value, b.value) AS value,
       CASE WHEN a.value IS NULL THEN 'test_only' ELSE 'train_only' END AS side, coalesce(a.n, b.n) AS n_rows
FROM (SELECT 'service' AS column_name, service AS value, count(*) AS n FROM train WHERE service <> 'Brand#4' GROUP BY service
      UNION ALL SELECT 'proto', proto, count(*) FROM train WHERE service <> 'Brand#4' GROUP BY proto) a
FULL OUTER JOIN
     (SELECT 'service' AS column_name, service AS value, count(*) AS n FROM test WHERE proto <> 'R' GROUP BY service
      UNION ALL SELECT 'proto', proto, count(*) FROM test WHERE proto <> 'R' GROUP BY proto) b
ON a.column_name = b.column_name AND a.value = b.value WHERE a.value IS NULL OR b.value IS NULL""", "train", "test"))
def _domain_shift(spark, sf):
    train, test = splits(spark, sf)
    return ex.domain_shift(train.filter("service <> 'Brand#4'"), test.filter("proto <> 'R'"), ["service", "proto"])


@query("label_decode", sql("SELECT id, CAST(y AS INTEGER) AS y, attack_cat AS decoded FROM probs", "probs"))
def _label_decode(spark, sf):
    return probs(spark, sf).select("id", "y", class_name(F.col("y"), CLASSES).alias("decoded"))


@query("leak_rows", sql("""
SELECT id, service, spkts, sttl, rate FROM test t WHERE EXISTS (
SELECT 1 FROM train r WHERE r.service IS NOT DISTINCT FROM t.service AND r.spkts IS NOT DISTINCT FROM t.spkts
  AND r.sttl IS NOT DISTINCT FROM t.sttl AND r.rate IS NOT DISTINCT FROM t.rate)""", "train", "test"))
def _leak_rows(spark, sf):
    train, test = splits(spark, sf)
    keys = ["service", "spkts", "sttl", "rate"]
    return pr.leaked_rows(train, test, keys).select("id", *keys)


# ---- profiling --------------------------------------------------------------


@query("target_distribution", sql("""
SELECT 'label' AS target, CAST(label AS VARCHAR) AS value, count(*) AS n_rows,
       round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM flows), 3) AS pct FROM flows GROUP BY label
UNION ALL SELECT 'attack_cat', attack_cat, count(*), round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM flows), 3)
FROM flows GROUP BY attack_cat""", "flows"))
def _target_distribution(spark, sf):
    return pr.target_distribution(flows(spark, sf))


@query("value_counts", sql("""
SELECT service, count(*) AS n_rows, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM flows_dirty), 3) AS pct
FROM flows_dirty GROUP BY service""", "flows_dirty"))
def _value_counts(spark, sf):
    return pr.value_counts(flows_dirty(spark, sf), "service")


_DIRTY = ["id", "proto", "service", "state", "spkts", "sbytes", "rate", "dur", "label", "attack_cat", "split"]


@query("null_profile", sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing FROM flows_dirty" for c in _DIRTY)
    + ") WHERE n_missing > 0", "flows_dirty"))
def _null_profile(spark, sf):
    return pr.null_profile(flows_dirty(spark, sf))


@query("inf_profile", sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (isinf({c})) AS n_infinite FROM flows_dirty"
        for c in ("spkts", "sbytes", "rate", "dur")) + ") WHERE n_infinite > 0", "flows_dirty"))
def _inf_profile(spark, sf):
    return pr.inf_profile(flows_dirty(spark, sf))


_COPIES = "SELECT id, proto, state, spkts, rate FROM flows UNION ALL SELECT id, proto, state, spkts, rate FROM flows WHERE spkts < 10"


def _with_copies(spark, sf):
    rows = flows(spark, sf).select("id", "proto", "state", "spkts", "rate")
    return rows.unionByName(rows.filter("spkts < 10"))


@query("dup_count", sql("SELECT (SELECT count(*) FROM c) - (SELECT count(*) FROM (SELECT DISTINCT * FROM c)) AS n_duplicates", "flows", c=_COPIES))
def _dup_count(spark, sf):
    return pr.duplicate_count(_with_copies(spark, sf))


@query("dup_count_noid", sql(
    "SELECT (SELECT count(*) FROM c) - (SELECT count(*) FROM (SELECT DISTINCT proto, state, spkts, rate FROM c)) AS n_duplicates",
    "flows", c=_COPIES))
def _dup_count_noid(spark, sf):
    return pr.duplicate_count(_with_copies(spark, sf), ignore=["id"])


def _profile_sql(source: str, columns: list[str]) -> str:
    body = [c for c in columns if c != "split"]
    missing = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in body)
    return f"""
SELECT split, count(*) AS n_rows, CAST({len(body)} AS BIGINT) AS n_columns, {missing} AS total_missing,
       count(*) FILTER (isinf(sbytes)) AS total_infinite,
       count(*) - count(DISTINCT ({', '.join(body)})) AS exact_duplicates,
       count(*) - count(DISTINCT ({', '.join(c for c in body if c != 'id')})) AS duplicates_without_id
FROM {source} GROUP BY split"""


@query("split_profile", sql(_profile_sql("flows_dirty", _DIRTY), "flows_dirty"))
def _split_profile(spark, sf):
    return pr.split_profile(flows_dirty(spark, sf), by="split")


@query("clean_audit", sql(
    f"SELECT *, 'before' AS stage FROM ({_profile_sql('flows_dirty', _DIRTY)}) UNION ALL "
    f"SELECT *, 'after' AS stage FROM ({_profile_sql('cleaned', _DIRTY)})", "cleaned"))
def _clean_audit(spark, sf):
    raw = stored(flows_dirty(spark, sf), "dirty")  # the joins behind it are made once for all six aggregates
    return pr.clean_audit(raw, cleaning.clean_split(raw, by="split"), by="split")


@query("split_sizes", sql("SELECT split, count(*) AS n_rows FROM flows GROUP BY split", "flows"))
def _split_sizes(spark, sf):
    return pr.split_sizes(flows(spark, sf))


# ---- exploration ------------------------------------------------------------


@query("category_profile", sql("""
SELECT column_name, split, n_distinct, rank, value, n_rows FROM (
  SELECT *, count(*) OVER (PARTITION BY column_name, split) AS n_distinct,
         row_number() OVER (PARTITION BY column_name, split ORDER BY n_rows DESC, value) AS rank FROM k) WHERE rank <= 5""", "flows",
    k=" UNION ALL ".join(f"SELECT '{c}' AS column_name, split, {c} AS value, count(*) AS n_rows FROM flows GROUP BY split, {c}" for c in CATEGORICAL)))
def _category_profile(spark, sf):
    return ex.category_profile(*splits(spark, sf), CATEGORICAL)


@query("variance_profile", sql("""
SELECT side, feature, round(sqrt(variance), 4) AS deviation, near_zero FROM (
 (SELECT 'lowest' AS side, feature, round(v, 6) AS variance, v < 0.0001 AS near_zero FROM k ORDER BY v, feature LIMIT 4) UNION ALL
 (SELECT 'highest', feature, round(v, 2), v < 0.0001 FROM k ORDER BY v DESC, feature LIMIT 4))""", "train",
    k=" UNION ALL ".join(f"SELECT '{c}' AS feature, var_samp({c}) AS v FROM train" for c in NUMERIC)))
def _variance_profile(spark, sf):
    out = ex.variance_profile(splits(spark, sf)[0], NUMERIC, k=4)
    return out.select("side", "feature", round_to(F.sqrt("variance"), 4).alias("deviation"), "near_zero")


@query("numeric_describe", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS n_rows, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
    round(quantile_cont({c}, 0.75), 4) AS q75 FROM cleaned""" for c in ("spkts", "sbytes", "rate", "dur")), "cleaned"))
def _numeric_describe(spark, sf):
    clean = materialize(cleaning.clean_infinities(flows_dirty(spark, sf)).select("spkts", "sbytes", "rate", "dur"))
    out = ex.numeric_describe(clean, ["spkts", "sbytes", "rate", "dur"])
    return out.select("feature", "n_rows", "min", "max", *[round_to(c, 4).alias(c) for c in ("mean", "std", "q25", "q50", "q75")])


@query("rare_classes", sql("""
SELECT attack_cat, train_count, round(train_count * 100.0::DOUBLE / n_train, 3) AS train_pct, test_count,
       round(test_count * 100.0::DOUBLE / n_test, 3) AS test_pct,
       round(train_count / nullif(test_count, 0)::DOUBLE, 2) AS ratio_train_to_test,
       CASE WHEN train_count * 100.0::DOUBLE / n_train < 2 THEN 'Rare' ELSE 'Standard' END AS priority
FROM (SELECT attack_cat, count(*) FILTER (split = 'train') AS train_count, count(*) FILTER (split = 'test') AS test_count,
             (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM test) AS n_test FROM flows GROUP BY attack_cat)
WHERE attack_cat IN ('Analysis', 'Backdoor', 'Shellcode', 'Worms')""", "train", "test"))
def _rare_classes(spark, sf):
    return ex.rare_classes(*splits(spark, sf))


def _corr_sql(columns):
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2,
        CASE WHEN var_pop({a}) FILTER ({b} IS NOT NULL) > 0 AND var_pop({b}) FILTER ({a} IS NOT NULL) > 0 THEN corr({a}, {b}) END AS r
        FROM cleaned""" for a, b in pairs)


_CORR = ["spkts", "sbytes", "rate", "dur", "label"]


@query("corr_pairs", sql("SELECT feature_1, feature_2, round(r, 4) AS correlation FROM k WHERE abs(r) >= 0.002", "cleaned", k=_corr_sql(_CORR)))
def _corr_pairs(spark, sf):
    return ex.corr_pairs(cleaning.clean_split(flows_dirty(spark, sf), by="split"), _CORR, 0.002)


_WIDE = [*NUMERIC, "label", "p"]


@query("corr_wide", sql("SELECT feature_1, feature_2, round(r, 4) AS correlation FROM k WHERE r IS NOT NULL", "train",
                        k=_corr_sql(_WIDE).replace("FROM cleaned", "FROM train")))
def _corr_wide(spark, sf):
    pairs = ex.correlations(splits(spark, sf)[0], _WIDE).filter("r IS NOT NULL")
    return pairs.select("feature_1", "feature_2", round_to("r", 4).alias("correlation"))


@query("corr_matrix", sql("""
SELECT feature_1, feature_2, round(r, 4) AS correlation FROM k UNION ALL SELECT feature_2, feature_1, round(r, 4) FROM k
UNION ALL SELECT f, f, CASE WHEN f <> 'dttl' THEN CAST(1 AS DOUBLE) END FROM (SELECT unnest(['spkts', 'sload', 'sttl', 'dttl']) AS f)""",
    "train", k=_corr_sql(["spkts", "sload", "sttl", "dttl"]).replace("FROM cleaned", "FROM train")))
def _corr_matrix(spark, sf):
    return ex.corr_matrix(splits(spark, sf)[0], ["spkts", "sload", "sttl", "dttl"])


# ---- sampling ---------------------------------------------------------------

_QUOTA_CTES = {
    "sizes": "SELECT attack_cat, count(*) AS n_class, sum(count(*)) OVER () AS total FROM train GROUP BY attack_cat",
    "want": "SELECT *, CAST(ceil(total * 0.2) AS BIGINT) AS want FROM sizes",
    "base_quota": "SELECT attack_cat, want, (n_class * want) // total AS b, (n_class * want) % total AS rest FROM want",
    "quotas": """SELECT attack_cat, b + CASE WHEN row_number() OVER (ORDER BY rest DESC, attack_cat) <= want - sum(b) OVER ()
                 THEN 1 ELSE 0 END AS quota FROM base_quota""",
}


@query("stratified_split", sql("""
SELECT id, attack_cat, row_number() OVER (PARTITION BY attack_cat ORDER BY md5('42:' || id)) <= quota AS is_validation
FROM train JOIN quotas USING (attack_cat)""", "train", **_QUOTA_CTES))
def _stratified_split(spark, sf):
    train = splits(spark, sf)[0].select("id", "attack_cat")
    return sa.stratified_split(train, "attack_cat", ["id"])


_SMALL = {"Normal": 300, "Generic": 40, "Worms": 100_000}
_LARGE = {"Normal": 2500, "Generic": 1500, "Worms": 100_000}


def _sample_sql(quotas):
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in quotas.items())
    return f"""SELECT id, attack_cat FROM (SELECT id, attack_cat,
    row_number() OVER (PARTITION BY attack_cat ORDER BY md5('42:' || id)) AS rn FROM test)
    WHERE rn <= CASE attack_cat {arms} ELSE 0 END"""


@query("sample_per_class", sql(_sample_sql(_SMALL | {"Worms": 90}), "test"))
def _sample_per_class(spark, sf):
    return sa.sample_by_class(splits(spark, sf)[1], "attack_cat", ["id"], _SMALL | {"Worms": 90}).select("id", "attack_cat")


@query("sample_large", sql(_sample_sql(_LARGE), "test"))
def _sample_large(spark, sf):
    return sa.sample_by_class(splits(spark, sf)[1], "attack_cat", ["id"], _LARGE).select("id", "attack_cat")


_RULES = " UNION ALL ".join(f"SELECT '{s}' AS scenario, '{c}' AS attack_cat, {q} AS quota" for s, c, q in SCENARIO_QUOTAS)
_SCENARIOS = f"""
SELECT scenario, id, attack_cat, md5('42:shuffle:' || id) AS position_key FROM (
SELECT id, attack_cat, row_number() OVER (PARTITION BY attack_cat ORDER BY md5('42:' || id)) AS rn FROM test)
JOIN ({_RULES}) USING (attack_cat) WHERE rn <= quota"""


@query("scenarios", sql("SELECT * FROM s", "test", s=_SCENARIOS))
def _scenarios(spark, sf):
    return sa.scenarios(splits(spark, sf)[1], "attack_cat", ["id"]).select("scenario", "id", "attack_cat", "position_key")


@query("scenario_mix", sql("SELECT id, attack_cat, position_key FROM s WHERE scenario = 'mixed_demo'", "test", s=_SCENARIOS))
def _scenario_mix(spark, sf):
    mix = sa.scenario(splits(spark, sf)[1], "attack_cat", ["id"], "mixed_demo")
    return mix.orderBy("position_key", "id").select("id", "attack_cat", "position_key")


@query("scenario_counts", sql("SELECT scenario, attack_cat, count(*) AS n_rows FROM s GROUP BY scenario, attack_cat", "test", s=_SCENARIOS))
def _scenario_counts(spark, sf):
    return sa.scenario_counts(sa.scenarios(splits(spark, sf)[1], "attack_cat", ["id"]), "attack_cat")


@query("subset_check", sql("""
SELECT count(DISTINCT id) AS n_keys, count(DISTINCT id) FILTER (id NOT IN (SELECT id FROM test)) AS n_outside,
       true AS contained FROM s""", "test", s=_SCENARIOS))
def _subset_check(spark, sf):
    test = splits(spark, sf)[1]
    return pr.subset_check(sa.scenarios(test, "attack_cat", ["id"]), test, ["id"])


# ---- alert analytics --------------------------------------------------------


@query("alert_summary", sql("SELECT total, normal, attacks, critical, round(avg_confidence, 6) AS avg_confidence, risk_level FROM s", "alerts", s=_SUMMARY))
def _alert_summary(spark, sf):
    return al.alert_summary(alerts(spark, sf)).withColumn("avg_confidence", round_to("avg_confidence", 6))


@query("alerts_by_severity", sql("SELECT severity, count(*) AS n_events FROM alerts GROUP BY severity", "alerts"))
def _alerts_by_severity(spark, sf):
    return al.counts_by(alerts(spark, sf), "severity")


@query("alerts_by_prediction", sql("SELECT prediction, count(*) AS n_events FROM alerts GROUP BY prediction", "alerts"))
def _alerts_by_prediction(spark, sf):
    return al.counts_by(alerts(spark, sf), "prediction")


@query("alerts_by_type", sql("SELECT attack_type, count(*) AS n_events FROM alerts WHERE prediction = 'Attack' GROUP BY attack_type", "alerts"))
def _alerts_by_type(spark, sf):
    return al.attacks_by_type(alerts(spark, sf))


def _hist_sql(column, bins):
    return sql(f"""SELECT prediction, bin, n_events, round(bin * {1 / bins!r}::DOUBLE, 6) AS bin_start FROM (
    SELECT prediction, CAST(least(floor({column} * {bins}), {bins - 1}) AS INTEGER) AS bin, count(*) AS n_events
    FROM alerts GROUP BY 1, 2)""", "alerts")


@query("confidence_hist", _hist_sql("confidence", 20))
def _confidence_hist(spark, sf):
    return al.histogram(alerts(spark, sf), "confidence", 20)


@query("probability_hist", _hist_sql("binary_probability", 25))
def _probability_hist(spark, sf):
    return al.histogram(alerts(spark, sf), "binary_probability", 25)


@query("top_actions", sql("""
SELECT left(recommended_action, 55) || '…' AS action, n AS n_events FROM (
SELECT recommended_action, count(*) AS n FROM alerts GROUP BY 1 ORDER BY n DESC, recommended_action LIMIT 8)""", "alerts"))
def _top_actions(spark, sf):
    return al.top_actions(alerts(spark, sf))


@query("latest_alerts", sql("""
SELECT event_id, attack_type, severity, confidence FROM alerts WHERE prediction = 'Attack'
ORDER BY timestamp DESC, event_id DESC LIMIT 5""", "alerts"))
def _latest_alerts(spark, sf):
    return al.latest_attacks(alerts(spark, sf)).select("event_id", "attack_type", "severity", "confidence")


@query("alert_timeline", sql("""
SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts, binary_probability, prediction FROM alerts WHERE record_index % 7 <> 0""", "alerts"))
def _alert_timeline(spark, sf):
    text = F.when(F.col("record_index") % 7 == 0, "not a time").otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    points = al.timeline(alerts(spark, sf).withColumn("timestamp", text))
    return points.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query("alert_detail", sql("SELECT event_id, prediction, attack_type, confidence FROM alerts WHERE event_id = '77'", "alerts"))
def _alert_detail(spark, sf):
    return al.detail(alerts(spark, sf), "77").select("event_id", "prediction", "attack_type", "confidence")


@query("alert_rows", sql("""
SELECT event_id, CASE WHEN prediction = 'Attack' THEN attack_type END AS attack_category, prediction = 'Attack' AS is_attack, confidence
FROM alerts""", "alerts"))
def _alert_rows(spark, sf):
    events = alerts(spark, sf).withColumns({"srcip": F.col("event_id"), "dstip": F.lit("-"), "proto": F.lit("tcp")})
    return tr.alert_rows(events).select(F.col("src_ip").alias("event_id"), "attack_category", "is_attack", "confidence")
