from __future__ import annotations

import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.operators import validation as va
from flowsieve.operators.alerts import newest_per_key
from flowsieve.plans import pipelines as pl
from flowsieve.schemas import FLOW_SCHEMA, FORBIDDEN_FIELDS, OUTPUT_FIELDS
from flowsieve.sources import readers, writers
from flowsieve.streaming import replay as st

CLASSES = ["DoS", "Normal"]


def _flow_csv(path, n, extra=""):
    names = [f.name for f in FLOW_SCHEMA.fields]
    lines = [",".join(names)]
    for i in range(n):
        values = {"id": i, "service": "-", "proto": " tcp ", "state": "FIN", "attack_cat": "Generic", "label": i % 2}
        lines.append(",".join(str(values.get(c, "1" if i % 5 else "NA")) for c in names))
    path.write_text("\n".join(lines) + "\n" + extra)
    return str(path)


def test_csv_tokens_and_types(spark, tmp_path):
    df = readers.read_csv(spark, _flow_csv(tmp_path / "a.csv", 10))
    assert df.schema == FLOW_SCHEMA and df.count() == 10
    assert df.filter("rate is null").count() == 2 and df.filter("service = '-'").count() == 10
    with pytest.raises(FileNotFoundError):
        readers.read_csv(spark, str(tmp_path / "none.csv"))


def test_malformed_csv_fails(spark, tmp_path):
    path = _flow_csv(tmp_path / "a.csv", 3, extra="abc,1,2\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, path).collect()
    schema = T.StructType([T.StructField("x", T.DoubleType())])
    assert readers.read_csv_or_empty(spark, str(tmp_path / "none.csv"), schema).count() == 0


def test_preparation_run(spark, tmp_path):
    a, b = _flow_csv(tmp_path / "a.csv", 20), _flow_csv(tmp_path / "b.csv", 7)
    train, test = pl.prepare_csv(spark, a, b, str(tmp_path / "clean"))
    assert (train.count(), test.count()) == (20, 7)
    assert {r[0] for r in train.select("proto").distinct().collect()} == {"tcp"}
    assert train.filter("label = 0 AND attack_cat <> 'Normal'").count() == 0
    assert {r["split"]: r["n_rows"] for r in pl.profile_splits(train, test).collect()} == {"train": 20, "test": 7}


def test_scenario_errors_and_limits(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_scenario(spark, str(tmp_path / "none"), ["id"])
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="empty"):
        readers.read_scenario(spark, str(tmp_path / "empty"), ["id"])
    spark.range(20).write.parquet(str(tmp_path / "full"))
    read = lambda n: [r["id"] for r in readers.read_scenario(spark, str(tmp_path / "full"), ["id"], n).orderBy("id").collect()]
    assert read(3) == [0, 1, 2] and len(read(0)) == len(read(None)) == len(read(-1)) == 20


def test_threshold_metadata(spark, tmp_path):
    path = tmp_path / "meta.json"
    assert readers.read_threshold(spark, str(path)) == 0.8
    path.write_text(json.dumps({"selected_threshold": 0.65}, indent=2))
    assert readers.read_threshold(spark, str(path)) == 0.65
    path.write_text("{not json")
    assert readers.read_threshold(spark, str(path)) == 0.8


def test_readiness_metrics_and_nan(spark, tmp_path):
    metrics = spark.createDataFrame([("a", 1.0), ("b", None)], "model string, f1 double")
    writers.write_metrics(metrics, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m" / "json")).count() == spark.read.csv(str(tmp_path / "m" / "csv"), header=True).count() == 2
    ready = {r[0]: r[1] for r in readers.readiness(spark, {"m": str(tmp_path / "m"), "x": str(tmp_path / "x")}).collect()}
    assert ready == {"m": True, "x": False}
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert readers.nan_to_null(df).filter("v is null").count() == 2


def test_manifest(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"hello")
    row = readers.file_manifest(spark, str(tmp_path)).first()
    assert (row["file_name"], row["size_bytes"], row["sha256"]) == ("x.bin", 5, hashlib.sha256(b"hello").hexdigest())
    assert readers.list_sources(spark, str(tmp_path), "*.bin").count() == 1


def test_manifest_reads_files_in_pieces(spark, tmp_path):
    """Files of any size and name are hashed, and no content goes into a cell."""
    files = {"one.bin": b"1", "a b%20c+ä.bin": bytes(range(256)) * 9000, "deep/x=1/y.bin": b"\n\r\n" * 5}
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    found = readers.file_manifest(spark, str(tmp_path), hash_bytes=3)
    assert "content:binary" not in found._jdf.queryExecution().executedPlan().toString()  # of what is read
    got = {r["file_name"]: (r["size_bytes"], r["sha256"]) for r in found.collect()}
    assert got == {n.split("/")[-1]: (len(c), hashlib.sha256(c).hexdigest()) for n, c in files.items()}


def _records(spark, n=40):
    return spark.range(n).select(
        F.col("id").alias("record_index"), (F.col("id") / n).alias("x"), (F.col("id") / n).alias("p"),
        F.array(F.lit(0.7), F.lit(0.3)).alias("probs"), *[F.lit(1).alias(c) for c in FORBIDDEN_FIELDS])


def _replayed(df):
    return st.replay(df, lambda d: d, "r", ["x", "p", "probs"], classes=CLASSES, threshold=0.5)


def test_file_sinks(spark, tmp_path):
    events = _replayed(_records(spark))
    assert writers.sink("JSONL ")(events, str(tmp_path / "j")) == 40
    assert writers.sink("csv")(events, str(tmp_path / "c")) == 40
    lines = [json.loads(t[0]) for t in spark.read.text(str(tmp_path / "j")).collect()]
    assert all(list(x) == OUTPUT_FIELDS for x in lines) and sum(x["multiclass_probability"] is None for x in lines) == 20
    assert lines[0]["timestamp"].count("T") == 1
    back = spark.read.csv(str(tmp_path / "c"), header=True)
    assert back.columns == OUTPUT_FIELDS and back.filter("multiclass_probability is null").count() == 20
    with pytest.raises(ValueError, match="unsupported"):
        writers.sink("xlsx")


def test_keyed_table_upserts_and_compacts(spark, tmp_path):
    events, path = _replayed(_records(spark)), str(tmp_path / "t")
    writers.upsert_events(events, path, 0)
    writers.upsert_events(events.withColumn("severity", F.lit("High")).filter("record_index < 10"), path, 1)
    writers.upsert_events(events.withColumn("severity", F.lit("High")).filter("record_index < 10"), path, 1)  # repeated batch
    state = writers.read_events(spark, path)
    assert state.count() == 40 and state.filter("severity = 'High' AND record_index < 10").count() == 10
    assert writers.compact_events(spark, path, str(tmp_path / "t2")) == 40
    assert writers.read_events(spark, str(tmp_path / "t2")).count() == 40
    with pytest.raises(ValueError):
        writers.compact_events(spark, path, str(tmp_path / "t2"))


@pytest.mark.parametrize("fmt", ["jsonl", "csv", "table"])
def test_a_second_run_keeps_the_first(spark, tmp_path, fmt):
    out = str(tmp_path / "out")
    for run, keep in enumerate(("record_index < 30", "record_index >= 20")):
        records = _records(spark).filter(keep)
        events = _replayed(_stream(spark, tmp_path, records, name=f"in{run}")).withColumn("model_version", F.lit(str(run)))
        st.drain(st.start(events, fmt, out, str(tmp_path / f"check{run}")))
    if fmt == "table":
        rows = writers.read_events(spark, out).collect()
        assert len(rows) == 40 and {r["record_index"] for r in rows if r["model_version"] == "1"} == set(range(20, 40))
        writers.sink("table")(_replayed(_records(spark)).filter("record_index = 3").withColumn("model_version", F.lit("2")), out)
        assert writers.read_events(spark, out).filter("model_version = '2'").count() == 1
    else:
        assert spark.read.text(f"{out}/run=*/batch=*").filter("value not like 'event_id%'").count() == 50


def test_session_export(spark, tmp_path):
    writers.export_session(_replayed(_records(spark)), str(tmp_path / "s"))
    summary = {r["metric"]: r["value"] for r in spark.read.csv(str(tmp_path / "s" / "summary"), header=True).collect()}
    assert summary["total"] == "40" and summary["attacks"] == "20"


def test_scenarios_are_written_per_directory(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "scenario string, id int")
    assert writers.write_scenarios(df, str(tmp_path / "sc")) == 2
    assert (tmp_path / "sc" / "scenario=a").exists()


# ---- streams ----------------------------------------------------------------


def _stream(spark, tmp_path, df, files=4, limit=None, name="in"):
    path = str(tmp_path / name)
    st.stage(df, path, files, ["record_index"], limit)
    return st.read_stream(spark, path, df.schema)


@pytest.mark.parametrize("fmt", ["jsonl", "csv", "table"])
def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, fmt):
    batch = {r["event_id"]: r["attack_type"] for r in _replayed(_records(spark)).collect()}
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for attempt in range(2):
        st.drain(st.start(_replayed(_stream(spark, tmp_path, _records(spark), name="in") if attempt == 0
                                    else st.read_stream(spark, str(tmp_path / "in"), _records(spark).schema)), fmt, out, check))
    if fmt == "table":
        rows = writers.read_events(spark, out).collect()
    elif fmt == "jsonl":
        rows = spark.read.json(f"{out}/run=*/batch=*").collect()
    else:
        rows = spark.read.csv(f"{out}/run=*/batch=*", header=True).collect()
    assert {r["event_id"]: r["attack_type"] for r in rows} == batch and len(rows) == 40
    assert not set(rows[0].asDict()) & set(FORBIDDEN_FIELDS)


def test_stream_limit_and_bad_format(spark, tmp_path):
    events = _replayed(_stream(spark, tmp_path, _records(spark), limit=7))
    st.drain(st.start(events, "table", str(tmp_path / "o"), str(tmp_path / "c")))
    assert writers.read_events(spark, str(tmp_path / "o")).count() == 7
    with pytest.raises(ValueError):
        st.start(events, "xlsx", "x", "y")


def test_paced_stream_can_be_stopped(spark, tmp_path):
    query = st.start(_replayed(_stream(spark, tmp_path, _records(spark))), "table", str(tmp_path / "o"), str(tmp_path / "c"), every="1 second")
    query.processAllAvailable()
    st.stop(query)
    assert not query.isActive and writers.read_events(spark, str(tmp_path / "o")).count() == 40


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:05:00"), ("b", "2024-01-01 00:10:00")]
    df = spark.createDataFrame(rows, "event_id string, t string").select("event_id", F.to_timestamp("t").alias("timestamp"))
    st.stage(df, str(tmp_path / "in"), 1)
    unique = st.without_repeats(st.read_stream(spark, str(tmp_path / "in"), df.schema))
    st.drain(st.start_batches(unique, st.write_latest(str(tmp_path / "o")), str(tmp_path / "c")))
    assert sorted(r["event_id"] for r in st.read_batches(spark, str(tmp_path / "o")).collect()) == ["a", "b"]


def test_late_rows_leave_closed_windows(spark, tmp_path):
    schema = "event_id string, timestamp timestamp, prediction string, binary_probability double"
    parts = [["2024-01-01 00:10:00", "2024-01-01 00:20:00"], ["2024-01-01 09:00:00"], ["2024-01-01 10:00:00"], ["2024-01-01 00:30:00", "2024-01-01 12:00:00"]]
    path = str(tmp_path / "in")
    for i, times in enumerate(parts):
        df = spark.createDataFrame([(f"{i}-{j}", t, "Attack", 0.9) for j, t in enumerate(times)], "event_id string, t string, prediction string, binary_probability double")
        df = df.select("event_id", F.to_timestamp("t").alias("timestamp"), "prediction", "binary_probability")
        df.coalesce(1).write.mode("append").parquet(path)
    counts = st.running_timeline(st.read_stream(spark, path, spark.createDataFrame([], schema).schema))
    st.drain(st.start_batches(counts, st.write_latest(str(tmp_path / "o")), str(tmp_path / "c")))
    rows = st.read_batches(spark, str(tmp_path / "o")).collect()
    first = [r for r in rows if r["window_start"].hour == 0]
    assert len(first) == 1 and first[0]["n_events"] == 2


def test_stream_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(1, "5"), (2, "bad")], "id int, dur string")
    st.stage(df, str(tmp_path / "in"), 1)
    checked = va.validate_rows(st.read_stream(spark, str(tmp_path / "in"), df.schema), ["dur"])
    st.drain(st.quarantine_batches(checked, str(tmp_path / "g"), str(tmp_path / "b"), str(tmp_path / "c")))
    assert [r["id"] for r in st.read_batches(spark, str(tmp_path / "g")).collect()] == [1]
    bad = st.read_batches(spark, str(tmp_path / "b")).first()
    assert (bad["id"], bad["dur"], bad[va.REASONS]) == (2, "bad", ["not_numeric:dur"])


def test_failed_stream_is_reported(spark, tmp_path):
    df = spark.createDataFrame([(1, "bad")], "id int, dur string")
    st.stage(df, str(tmp_path / "in"), 1)
    checked = va.apply_policy(va.validate_rows(st.read_stream(spark, str(tmp_path / "in"), df.schema), ["dur"]), "fail")
    with pytest.raises(Exception, match="not_numeric"):
        st.drain(st.start_batches(checked, lambda b, e: b.collect(), str(tmp_path / "c")))


# -- published batches and closed windows ------------------------------------------


def test_half_a_batch_is_not_visible_and_is_replaced(spark, tmp_path):
    from flowsieve.sources import published as pub

    path = str(tmp_path / "sink")
    rows = spark.range(10).withColumn("v", F.lit("first"))
    save = lambda df, where: df.write.mode("overwrite").parquet(where)

    def broken(df, where):
        df.limit(3).write.mode("overwrite").parquet(where)
        raise RuntimeError("killed half way")

    pub.write_batch(rows, path, 0, 0, save)
    with pytest.raises(RuntimeError, match="half way"):
        pub.write_batch(rows, path, 0, 1, broken)
    assert pub.published(spark, path) == [(0, 0)] and spark.read.parquet(*pub.published_paths(spark, path)).count() == 10
    pub.write_batch(rows.limit(7), path, 0, 1, save)  # the restart writes it anew
    assert pub.published(spark, path) == [(0, 0), (0, 1)] and spark.read.parquet(*pub.published_paths(spark, path)).count() == 17
    with pytest.raises(RuntimeError, match="half way"):  # a batch that is written again is withdrawn meanwhile
        pub.write_batch(rows, path, 0, 0, broken)
    assert pub.published(spark, path) == [(0, 1)]
    pub.write_batch(rows, path, 2, 5, save)
    assert pub.published(spark, path) == [(0, 1), (2, 5)]
    assert pub.published(spark, str(tmp_path / "none")) == []


def test_sink_readers_see_published_batches_only(spark, tmp_path):
    path = str(tmp_path / "events")
    assert st.read_sink(spark, "jsonl", path).count() == 0
    (tmp_path / "events" / "run=0" / "batch=0").mkdir(parents=True)
    (tmp_path / "events" / "run=0" / "batch=0" / "part-0.json").write_text('{"event_id": "x"}')
    assert st.read_sink(spark, "jsonl", path).count() == 0


def test_windows_close_once_and_late_rows_are_counted(spark, tmp_path):
    def send(turn, rows):
        df = spark.createDataFrame([(t, k, v) for t, k, v in rows], "t string, prediction string, binary_probability double")
        df.withColumn("timestamp", F.to_timestamp("t")).drop("t").write.parquet(str(tmp_path / "in" / f"part={turn}"))
        st.drain(st.start_batches(st.closed_windows(events), st.write_latest(str(tmp_path / "out")), str(tmp_path / "checkpoint")))

    schema = "prediction string, binary_probability double, timestamp timestamp"
    (tmp_path / "in").mkdir()
    events = st.read_stream(spark, str(tmp_path / "in" / "*"), schema_of(schema), None)
    send(0, [("2024-01-01 10:05:00", "Attack", 0.9), ("2024-01-01 10:50:00", "Attack", 0.8), ("2024-01-01 13:10:00", "Normal", 0.1)])
    send(1, [("2024-01-01 10:59:00", "Attack", 0.7), ("2024-01-01 12:30:00", "Attack", 0.6), ("2024-01-01 20:00:00", "Normal", 0.2)])
    out = st.read_batches(spark, str(tmp_path / "out")).orderBy("window_start", "n_late").collect()
    got = [(r.window_start.hour, r.prediction, r.n_events, round(r.value_sum, 6), r.n_late) for r in out]
    assert got == [(10, "Attack", 2, 1.7, 0), (10, "Attack", 0, 0.0, 1), (12, "Attack", 1, 0.6, 0), (13, "Normal", 1, 0.1, 0)]


def schema_of(ddl):
    from pyspark.sql import types as T

    return T.StructType.fromDDL(ddl)


# -- keyed table in buckets ----------------------------------------------------------


def test_a_change_reads_and_writes_the_buckets_of_its_keys_only(spark, tmp_path):
    from flowsieve.sources import keyed

    path = str(tmp_path / "keyed")
    rows = spark.range(2000).select("id", F.lit(0).alias("v"))
    assert keyed.merge_rows(rows, path, "id", buckets=32) == list(range(32))
    first = keyed.manifest(spark, path)
    few = rows.filter(keyed.bucket_of(F.col("id"), 32).isin(3, 17) & (F.col("id") % 3 == 0)).withColumn("v", F.lit(1))
    new = spark.createDataFrame([(10_000, 5), (10_000, 7), (None, 9)], "id long, v int").filter(
        F.col("id").isNull() | keyed.bucket_of(F.col("id"), 32).isNotNull())
    wanted = {r.id: r.v for r in rows.collect()} | {r.id: 1 for r in few.collect()}
    assert keyed.merge_rows(few, path, "id") == [3, 17]
    second = keyed.manifest(spark, path)
    assert {b for b in range(32) if second.live[b] != first.live[b]} == {3, 17}
    files = lambda only: {f.split("/")[-2] for f in spark.read.parquet(*second.paths(path, only)).inputFiles()}
    assert files([3, 17]) == {"bucket=3", "bucket=17"}
    assert len(keyed.merge_rows(new, path, "id", order=F.col("v"))) == 1
    wanted[10_000] = 7
    assert {r.id: r.v for r in keyed.read_rows(spark, path).collect()} == wanted
    one = keyed.read_rows(spark, path, keys=[42])
    assert [(r.id, r.v) for r in one.collect()] == [(42, wanted[42])] and len({f.split("/")[-2] for f in one.inputFiles()}) == 1
    assert keyed.merge_rows(rows.limit(0), path, "id") == []
    with pytest.raises(ValueError):
        keyed.merge_rows(rows, path, "v")


def test_a_failed_merge_changes_nothing(spark, tmp_path, monkeypatch):
    from flowsieve.sources import keyed

    path = str(tmp_path / "keyed")
    keyed.merge_rows(spark.range(50).select("id", F.lit("a").alias("v")), path, "id", buckets=4)
    monkeypatch.setattr(keyed, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        keyed.merge_rows(spark.range(50).select("id", F.lit("b").alias("v")), path, "id")
    assert {r.v for r in keyed.read_rows(spark, path).collect()} == {"a"}
    monkeypatch.undo()
    keyed.merge_rows(spark.range(50).select("id", F.lit("b").alias("v")), path, "id")
    assert {r.v for r in keyed.read_rows(spark, path).collect()} == {"b"}


# -- paced replay ----------------------------------------------------------------------


def test_paced_replay_keeps_its_pace_and_restarts_at_its_offset(spark, tmp_path):
    rows = spark.range(100).select(F.concat(F.lit("k"), F.col("id")).alias("name"), F.col("id").alias("n"))
    assert st.stage_numbered(rows, str(tmp_path / "records"), ["n"]) == 100
    seen = []

    def to_events(part):
        seen.append(sorted(r.record_index for r in part.select("record_index").collect()))
        out = part.select(F.col("name").alias("event_id"), "record_index")
        for field in OUTPUT_FIELDS:
            if field not in out.columns:
                out = out.withColumn(field, F.lit(None).cast("string"))
        return out.withColumn("timestamp", F.current_timestamp())

    def play(total):
        query = st.start_paced(spark, str(tmp_path / "records"), to_events, str(tmp_path / "out"), str(tmp_path / "checkpoint"), 30, "1 second")
        return st.drain_paced(query, total)

    first = play(60)
    assert all(s["records"] == 30 for s in first) and seen[0] == list(range(30)) and seen[1] == list(range(30, 60))
    play(60)  # the counter runs past the last record
    numbers = [n for part in seen for n in part]
    assert set(numbers) == set(range(100))
    assert writers.read_events(spark, str(tmp_path / "out")).count() == 100


def test_a_large_scenario_is_not_moved_into_so_few_tasks(spark, tmp_path):
    path, df = str(tmp_path / "in"), spark.range(0, 4000, 1, 8)
    st.stage(df, path, 3, rows_per_file=500)  # more than three full files: the eight parts stay as they are
    assert len(spark.read.parquet(path).inputFiles()) == 8 and spark.read.parquet(path).distinct().count() == 4000
    st.stage(df, path, 3)
    assert len(spark.read.parquet(path).inputFiles()) == 3 and spark.read.parquet(path).distinct().count() == 4000
    assert st.stage_batches(df, path, 2) == 1


def test_text_sinks_can_be_compressed(spark, tmp_path):
    for fmt in ("jsonl", "csv"):
        out = str(tmp_path / fmt)
        st.drain(st.start(_replayed(_stream(spark, tmp_path, _records(spark), name=f"in-{fmt}")), fmt, out, f"{out}-check", compression="gzip"))
        assert all(p.name.endswith(".gz") for p in (tmp_path / fmt).rglob("part-*") if not p.name.endswith(".crc") and "publish" not in str(p))
        assert st.read_sink(spark, fmt, out).select("event_id").distinct().count() == 40


def test_streams_leave_no_copies_of_their_input(spark, sf_dir):
    """Once staged, numbered records are deleted, and staged ones once they are replayed."""
    from flowsieve.plans import queries_stream as qs
    from flowsieve.session import checkpoint_root

    scratch = Path(checkpoint_root(spark).removeprefix("file:")) / "scratch"
    assert scratch.parent.exists()
    inputs = lambda: {p.name for p in scratch.glob("*") if p.name.split("-")[0] in ("unnumbered", "ranged", "replay", "run0", "run1")}
    before = inputs()
    for run in (qs._replay_stream, qs._upsert_two_runs):
        assert run(spark, sf_dir).count() > 0
        assert inputs() <= before


def test_newest_rows_are_shuffled_once(spark):
    events = spark.createDataFrame(
        [("a", 0, 1, None, "x"), ("a", 1, 1, None, "y"), ("a", 1, 0, 5.0, "z"), ("b", 0, None, 1.0, "w"), (None, 0, 0, 2.0, "v")],
        "event_id string, batch_seq long, record_index long, value double, text string")
    found = newest_per_key(events)
    assert found._jdf.queryExecution().executedPlan().toString().count("partial_max_by") == 0  # which holds a row and its order
    assert {tuple(r) for r in found.collect()} == {("a", 1, 1, None, "y"), ("b", 0, None, 1.0, "w"), (None, 0, 0, 2.0, "v")}
