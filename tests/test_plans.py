"""Plan shapes that matter at scale: pushdown, single scans, no cartesian products, no one-task windows."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import functions as F

from flowsieve.operators import cleaning, exploration, metrics, profiling, sampling
from flowsieve.plans import catalog, views
from flowsieve.session import checkpoint_root, scratch_path

ROOT = Path(__file__).resolve().parents[1]


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_sweep_reads_only_its_columns_in_one_scan(spark, tmp_path):
    spark.range(100).select((F.col("id") % 2).alias("y"), (F.col("id") / 100).alias("p"), *[F.lit(1).alias(f"c{i}") for i in range(20)]).write.parquet(str(tmp_path / "s"))
    text = plan(metrics.threshold_sweep(spark.read.parquet(str(tmp_path / "s"))))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert re.search(r"ReadSchema: struct<y:bigint,p:double>", text)


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(views.table(spark, sf_dir, "lineitem").filter("l_quantity > 5").select("l_orderkey"))
    assert "GreaterThan(l_quantity,5" in text


def test_overlap_is_one_aggregate_without_a_join(spark, sf_dir):
    df = views.table(spark, sf_dir, "lineitem")
    text = plan(profiling.split_overlap(df, df, ["l_orderkey"]))
    assert "Join" not in text and "partial_count" in text


def test_cleaning_never_shuffles_rows(spark, sf_dir):
    df = views.table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "proto")
    assert "Exchange" not in plan(cleaning.clean_strings(cleaning.clean_infinities(df)))


def test_small_samples_are_pruned_before_the_shuffle(spark, sf_dir):
    df = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("cls"))
    text = plan(sampling.sample_by_class(df, "cls", ["l_orderkey", "l_linenumber"], {"A": 50, "N": 20}))
    assert "WindowGroupLimit" in text


def test_top_values_are_pruned_before_the_shuffle(spark, sf_dir):
    df = views.table(spark, sf_dir, "lineitem")
    assert "WindowGroupLimit" in plan(exploration.category_profile(df, df, ["l_returnflag"]))


def test_split_marking_moves_no_rows(spark, sf_dir):
    df = views.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("cls"))
    text = plan(sampling.stratified_split(df, "cls", ["l_orderkey"]))
    assert "Exchange hashpartitioning" not in text and "Window" not in text


def test_no_query_plans_a_cartesian_product(spark, sf_dir):
    catalog.load()
    trained = ("train_", "attack_only_eval", "threshold_selection_run", "perm_", "detect", "saved_", "evaluate_one", "stream_", "replay_", "dedup_")
    for name, fn in catalog.QUERIES.items():
        if not name.startswith(trained):
            text = plan(fn(spark, sf_dir))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_no_machine_local_checkpoints_or_row_udfs():
    for path in (ROOT / "flowsieve").rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and ".crossJoin(" not in text and "F.udf" not in text, path


def test_scratch_lies_under_the_checkpoint_folder(spark):
    assert scratch_path(spark, "x").startswith(checkpoint_root(spark))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert configured in checkpoint_root(spark)


def test_feature_width_makes_the_joins_behind_its_rows_once(spark, sf_dir, monkeypatch):
    """A fit reads its rows several times; they come from one stored table, not from the joins each time."""
    from flowsieve.plans import queries_metrics as qm

    plans = []
    plain = qm.fe.fit_features
    monkeypatch.setattr(qm.fe, "fit_features", lambda t, *a: plans.append(t._jdf.queryExecution().optimizedPlan().toString()) or plain(t, *a))
    assert qm._feature_width(spark, sf_dir).first().n_features > len(qm.NUMERIC)
    assert "Join" not in plans[0]
