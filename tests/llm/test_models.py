"""Language-model scores, decontamination and the pipeline."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import cases
import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from flowsieve.llm import decontamination as dc
from flowsieve.llm import maxent, queries


def lm_words(text):
    return [*cases.words((text or "").translate(cases.LOWER)), None]


def check_base(docs, out):
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    counts = Counter()
    for i, text in docs:
        if not held(i):
            counts.update(lm_words(text))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, text in docs:
        w = lm_words(text)
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)
        want.append((i, held(i), len(w), sum(counts[x] > 0 for x in w), total, round(base, 6)))
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=str) == sorted(want, key=str)


def test_scores_on_the_corpus(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.QUERIES["op3_maxent_scores"](spark, sf_dir).collect()
    check_base(docs, out)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # better than the unigram base on unseen documents
    assert all(r.score < 0 for r in out)


def test_scores_on_awkward_rows(spark):
    data = [(i, t) for i, t, *_ in cases.rows()] + [(None, "one two"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(*d, 0) for d in data], "doc_id long, text string, score int")
    check_base(data, maxent.score_texts(docs).collect())
    assert maxent.score_texts(docs.limit(0)).collect() == []
    # only held-out documents: nothing is known
    only = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    out = maxent.score_texts(docs.sparkSession.createDataFrame([(i, "a b") for i in only], "doc_id long, text string")).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in out)


def test_word_probabilities_add_up_to_one(spark, sf_dir):
    """Shares within each class: frequent words add up to one; rare ones leave the unseen share."""
    import pyarrow as pa

    n = 3000
    counts = np.arange(n, 0, -1)
    table = maxent.head_table(pa.table({"h": np.arange(n) * 7919, "last": np.arange(n, dtype=np.int32) % 97, "n": counts}))
    shares = np.bincount(table.classes, 10**table.share, maxent.CLASSES)
    used = np.unique(table.classes)
    assert np.allclose(shares[used], 1) and used.max() < maxent.FIRST_RARE


def test_training_beats_class_frequencies():
    rng = np.random.default_rng(0)
    classes = np.tile([1, 2, 3, 4], 5000)
    rows = np.stack([np.roll(classes, 1), np.roll(classes, 1) + 100, np.full(len(classes), 7)], 1)
    weights, bias = np.zeros((maxent.ROWS, maxent.CLASSES), np.float32), np.zeros(maxent.CLASSES, np.float32)
    before = maxent.log_softmax(weights, bias, rows)[np.arange(len(classes)), classes].mean()
    assert maxent.steps(weights, bias, iter([(classes, rows)])) == len(classes)
    after = maxent.log_softmax(weights, bias, rows)[np.arange(len(classes)), classes].mean()
    assert after > before + 1 and rng is not None


def test_steps_are_summed_over_levels(spark, monkeypatch):
    monkeypatch.setattr(maxent, "FAN_IN", 2)
    piece = np.arange(4, dtype=np.float32)
    rows = [(p, b, 1.0, bytearray((piece * (b + 1)).tobytes())) for p in range(5) for b in range(3)]
    change = spark.createDataFrame(rows, maxent._STEP_SCHEMA)
    while (change.agg(F.max("part")).first()[0] or 0) > 0:
        change = maxent._add_up(change.withColumn("part", F.floor(F.col("part") / maxent.FAN_IN)))
    got = {r.block: (r.n, np.frombuffer(bytes(r.data), np.float32).tolist()) for r in change.collect()}
    assert got == {b: (5.0, (piece * 5 * (b + 1)).tolist()) for b in range(3)}


ITEM = "Anna has 12 apples and 5 kg of pears. Then Anna gives 5 kg to Peter. How many apples does Anna keep for herself tomorrow?"
SAME = "Maria has 30 apples and 7 kg of pears. Then Maria gives 7 kg to Tom. How many apples does Maria keep for herself tomorrow?"
MIXED = "Maria has 30 apples and 7 kg of pears. Then Karl gives 9 kg to Tom. How many apples does Lisa keep for herself tomorrow?"


def test_templates(spark):
    items = dc.build_items([("q", ITEM), ("none", None), ("short", "Is 5?")])
    reader = dc.Reader()
    found = lambda text: {x[0] for x in dc.leaks(reader.read(text), items)}
    assert found(ITEM) == {"q"} and found("before, " + ITEM + " and after") == {"q"}
    assert found(SAME) == {"q"}
    assert found(MIXED) == set()  # the same template, but the values do not fit together
    assert found("Anna has 12 apples and 5 kg of pears.") == set()
    assert found("") == set() and found(cases.SENTENCE) == set()
    (hit,) = dc.leaks(reader.read(SAME), items)
    assert hit[3] > 0 and hit[4] < hit[3]


def test_leaks_with_a_stretch_put_in_or_taken_out():
    text = " ".join(f"{a} {b}" for a, b in zip("abcdefghijklmnopqrstuvwxyz", "the river ran down past old mills while quiet farmers walked home over wet fields under grey skies with heavy bags on their backs".split(), strict=False))
    words, reader = text.split(), dc.Reader()
    items = dc.build_items([("q", text)])
    found = lambda x: [h[0] for h in dc.leaks(reader.read(x), items)]
    remark = "page nine of this printed book which was made by them".split()
    assert len(remark) > 8 and found(" ".join(words[:22] + remark + words[22:])) == ["q"]
    assert found(" ".join(words[:14] + remark[:6] + words[14:30] + remark[4:] + words[30:])) == ["q"]
    assert found(" ".join(words[:22])) == [] and found(" ".join(words[22:] + remark + words[:22])) == []  # half, and out of order
    assert found(" ".join(words[:22] + remark * 40 + words[22:])) == []  # too far apart


def test_leaks_of_items_with_few_usable_windows(spark):
    rows = [("word", "Xylophon"), ("pair", "Quartz Veil"), ("sum", "12 * 7 + 3"), ("names", "Anna Bert Carl Dora Emil Fritz Gina Hans"), ("clause", "今天天气很好我们去公园散步")]
    one = "Anna and the old dog ran. Peter Bert 12 kg Gina Hans 7 kg Karl Lisa 9 cm"  # one window with three words that are no placeholders
    items, reader = dc.build_items([*rows, ("one", one)]), dc.Reader()
    found = lambda x: {h[0] for h in dc.leaks(reader.read(x), items)}
    for ident, text in [*rows, ("one", one)]:
        assert found(text) == {ident} and found(f"some words before, {text} and after it") == {ident}
    assert found("他说今天天气很好我们去公园散步然后回家") == {"clause"}
    assert found("then Tom and the old dog ran. After that it was late and all of them went home") == set()
    assert found("12 of them, 7 more and 3") == set() and found("Anna met Bert, and Carl saw Dora") == set()
    bench, docs = spark.createDataFrame(rows, "item_id string, text string"), cases.frame(spark, [(1, "so 12 * 7 + 3 is it", None, None, None), (2, "so 12 is it", None, None, None)])
    assert [(r.doc_id, r.item_id) for r in dc.find_leaks(docs, bench).collect()] == [(1, "sum")]
    assert [r.doc_id for r in dc.without_leaks(docs, bench).collect()] == [2]


def test_leaks_in_awkward_tables(spark, monkeypatch):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, ITEM), (None, "the quick brown fox jumps over the lazy dog and runs")], "item_id long, text string")
    data = [*cases.rows(), (100, ITEM, None, None, None), (100, ITEM, None, None, None), (None, SAME, None, None, None), (101, "x " * 9000 + "the quick brown fox jumps over the lazy dog and runs", None, None, None)]
    docs = cases.frame(spark, data).withColumnRenamed("source", "item_id")
    want = sorted([(100, 1), (100, 4)] * 2 + [(None, 1), (None, 4), (101, None)], key=str)
    for block in (1 << 20, 10):
        parts = list(dc.benchmark_blocks(bench, block_bytes=block))
        assert (len(parts) > 1) == (block == 10)
        monkeypatch.setattr(dc, "BLOCK_BYTES", block)
        monkeypatch.setattr(dc.benchmark_blocks, "__defaults__", ("item_id", "text", block))
        got = sorted(((r[0], r[1]) for r in dc.find_leaks(docs, bench).collect()), key=str)
        assert got == want
        kept = dc.without_leaks(docs, bench)
        assert kept.columns == docs.columns and kept.count() == len(cases.TEXTS)
    assert dc.find_leaks(docs, bench.limit(0)).collect() == [] and dc.find_leaks(docs.limit(0), bench).collect() == []


def test_repeated_benchmark_texts_are_read_once(spark):
    bench = spark.createDataFrame([(i, ITEM) for i in range(300)] + [(None, ITEM)], "item_id long, text string")
    (items,) = dc.benchmark_blocks(bench, block_bytes=4096)
    assert len(items.ids) == 1
    found = dc.find_leaks(cases.frame(spark, [(1, SAME, None, None, None)]), bench).collect()
    assert {r.item_id for r in found} == {*range(300), None} and len(found) == 301


def test_leaks_are_the_planted_passages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    want = {(d.doc_id, b.item_id) for d in docs for b in bench if b.text in (d.text or "")}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op5_decontamination"](spark, sf_dir).collect()}
    assert got == want and want


def test_pipeline_against_brute_force(spark, tmp_path):
    import public_tokenizers
    import tiktoken
    from test_filters import feature_row
    from test_repeats import line_result, similarity

    from flowsieve.llm import byte_bpe

    base = [" ".join(f"{w}{i}" for i in range(80)) for w in ("alpha", "beta", "gamma", "delta", "eps", "zeta")]
    texts = [f"{b}\n{cases.LINE}" for b in base] + [base[0] + "\n" + cases.LINE, base[1] + " " + ITEM, "too short", None, base[2] + " end", "#% " * 60]
    texts.append(" ".join(f"omega{i}" for i in range(80)) + "\n" + cases.LINE)  # the largest holder of the line, so copies stay alike
    data = [(i, t, "en" if i % 2 else None, "s", 0) for i, t in enumerate(texts)]
    folder = str(tmp_path / "tables")
    cases.frame(spark, data).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [r for r in data if not feature_row(r[1])[-1]]
    rows = [(r[0], line_result(rows)[r[0]][0], *r[2:]) for r in rows]
    keep = {r[0] for r in rows if not any(s[0] < r[0] and similarity(r[1], s[1]) >= 0.8 for s in rows)}
    rows = [r for r in rows if r[0] in keep and ITEM not in r[1]]
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)), special_tokens={})
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: r.ids for r in out} == {r[0]: tik.encode_ordinary(r[1]) for r in rows}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_words_beyond_the_head_are_told_apart_as_history():
    """Rare words of one last byte share the features of that byte, and have features by their own hash too."""
    known = maxent.tokens([b"next"])
    table = maxent.head_table(pa.table({"h": known.hashes[:1].view(np.int64), "last": known.last[:1].astype(np.int32), "n": np.array([9])}))
    got = maxent.tokens([b"zebra next next", b"extra next next", b"next next next"])
    at, classes, rows = maxent.classify(got, table)
    first, second, third = rows.reshape(3, 4, -1)
    n = maxent.FEATURES
    np.testing.assert_array_equal(first[:, :n], second[:, :n])  # all that tells their contexts before
    assert (classes[:4] == classes[4:8]).all() and at[0] == at[4] == -1
    assert first[1, n] != second[1, n] and first[2, n + 1] != second[2, n + 1]
    assert (third[:, n:] == -1).all() and (first[[0, 3], n:] == -1).all() and first[1, n + 1] == first[2, n] == -1
    own = rows[:, n:][rows[:, n:] >= 0]
    assert len(own) == 4 and (own >= maxent.ROWS).all() and (own < maxent.ROWS + maxent.OWN).all()


def test_pairs_with_a_word_beyond_the_head_are_told_apart():
    """Each word of such a pair counts as itself: another rare word of the same last byte, or another neighbour, is another pair."""
    known = maxent.tokens([b"next last"])
    table = maxent.head_table(pa.table({"h": known.hashes[:2].view(np.int64), "last": known.last[:2].astype(np.int32), "n": np.array([9, 8])}))
    got = maxent.tokens([b"zebra next", b"extra next", b"zebra last", b"extra zebra x", b"zebra extra x", b"next last next"])
    pairs = maxent.with_pairs(maxent.classify(got, table)[2])[:, -1]
    at = got.offsets[:-1]
    both = pairs[at[:5] + 2]
    assert len(set(both)) == 5 and (both >= maxent.ROWS + maxent.OWN).all() and (both < maxent.ROWS + maxent.OWN + maxent.PAIRS).all()
    assert pairs[at[0] + 1] == pairs[at[2] + 1] != pairs[at[1] + 1]  # with the start of the text
    assert (pairs[at] == -1).all() and (pairs[at[5]:] == -1).all()


def test_sums_of_groups():
    rng = np.random.default_rng(3)
    for sizes in ([1], [1, 1, 1], [2], [7, 1, 1, 300, 2, 3, 64, 5], rng.integers(1, 9, 500)):
        values = rng.integers(-50, 50, (sum(sizes), 4)).astype(np.float32)
        cuts = np.cumsum([0, *sizes])[:-1]
        kept = values.copy()
        np.testing.assert_array_equal(maxent.group_sums(values, cuts), np.add.reduceat(kept, cuts, axis=0))
        np.testing.assert_array_equal(values, kept)
