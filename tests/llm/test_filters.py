"""URL rules, quality rules and sharding against brute force."""

from __future__ import annotations

import hashlib
import math
import time
import zlib
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F

from flowsieve.llm import quality_rules, queries, sharding, url_filter

URLS = [
    "http://ExAmple.org/es/1", "https://a.example.org/en/1?x", "https://example.org/en/2#y", "http://notexample.org/es/", "ftp://x.com/fr/a",
    "http://x.com/de/a/b", "http://com/de/", "http://xcom/de/", "http://a.org", "http://a.org?q=/es/", "no scheme", None, "", "://", "http://",
    "http://a.org/\n/es", "x://b.com/de/" + "p" * 50_000, "http://a..org/", "http://user@a.org:80/", "http://ÄB.ORG/é/ü",
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut].translate(cases.LOWER), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit) if fit else None
    return host, path, best[2] if best else None, best[3] if best else "allow"


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_urls(spark, limit):
    rules = [*queries.URL_RULES, ("example.org", "", "allow"), ("a.org", "/", "block")]
    data = [(i, u, "clash", None) for i, u in enumerate([*URLS, URLS[0]])]
    pages = spark.createDataFrame(data, "page_id long, url string, digests string, candidates string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("b.com", "x", "block"), ("b.com", "/", "maybe"), ("B.com", "/de/", "block")], "host string, path string, action string")
    out = {r.page_id: r for r in url_filter.filter_urls(pages, table, index_bytes=limit).collect()}
    assert len(out) == len(data)
    for i, url, *_ in data:
        assert (out[i].host, out[i].path, out[i].rule, out[i].verdict) == brute(url, [*rules, ("b.com", "/de/", "block")])
        assert out[i].digests == "clash"


def test_urls_without_rules_or_rows(spark):
    none = spark.createDataFrame([], "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in url_filter.filter_urls(pages, none).collect()] == [(None, "allow")]
    rules = spark.createDataFrame(queries.URL_RULES, none.schema)
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


def test_equal_digests_are_told_apart_by_the_strings():
    import numpy as np
    import pyarrow as pa

    stored = (np.array([5, 5, 9]), pa.array(["a/", "b/", "c/"], pa.large_string()), None, None)
    assert url_filter.probe(stored, np.array([5, 5, 9, 9]), pa.array(["b/", "x/", "c/", "d/"])).tolist() == [1, -1, 2, -1]


def feature_row(text):
    w, t = cases.words(text), text or ""
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(triples)
    covered = {i + k for i, g in enumerate(triples) if count[g] > 1 for k in range(3)}
    lines = [line for line in t.split("\n") if cases.WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in t)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_quality_features(spark):
    docs = cases.frame(spark).withColumnRenamed("source", "words").withColumnRenamed("n_chars", "windows")
    out = {r.doc_id: r for r in quality_rules.with_features(docs).collect()}
    for doc_id, text, *_ in cases.rows():
        r = out[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == feature_row(text)


def _labelled(spark, good, bad, lang):
    fine = " ".join(f"w{i}" for i in range(60))
    poor = " ".join(f"w{i}#%" for i in range(60))
    docs = [(i, fine if i < good else poor, lang, "s", 0) for i in range(good + bad)]
    return docs, [(d[0], int(d[0] < good), 0) for d in docs]


def test_cutoffs_follow_the_exact_bound(spark):
    many, labels = _labelled(spark, 3000, 200, "en")
    few = [(10_000 + i, t, "de", s, n) for i, t, _, s, n in _labelled(spark, 300, 50, "de")[0]]
    labels += [(10_000 + i, q, 0) for i, q, _ in _labelled(spark, 300, 50, "de")[1]] + [(1, None, None), (99_999, 1, 0)]
    docs = cases.frame(spark, many + few)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    _, cutoffs = quality_rules.calibrate(docs, table)
    found = {r.stratum: r.cutoffs for r in cutoffs.collect()}
    # 3,000 good documents without a rejection prove the share; 300 cannot.
    assert "symbols" in found["en"] and "de" not in found
    kept = quality_rules.reject_low_quality(docs, table)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {d[0] for d in many if d[0] < 3000} <= ids and not {d[0] for d in many if d[0] >= 3000} & ids
    assert {d[0] for d in few} <= ids


def test_binomial_tail_is_exact(spark):
    cases_ = [(0, 10), (1, 10), (3, 500), (40, 9000), (5, 20)]
    table = spark.createDataFrame(cases_, "k long, n long")
    for r in table.withColumn("tail", quality_rules.log_binomial_tail(F.col("k"), F.col("n"), 0.004)).collect():
        exact = sum(math.comb(r.n, i) * 0.004**i * 0.996 ** (r.n - i) for i in range(r.k + 1))
        assert math.isclose(r.tail, math.log(exact), rel_tol=1e-9, abs_tol=1e-9)


def test_quality_on_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.reject_low_quality(cases.frame(spark, []), labels).collect() == []
    kept = quality_rules.reject_low_quality(cases.frame(spark), labels)
    assert {r.doc_id for r in kept.collect()} == {i for i, t, *_ in cases.rows() if not feature_row(t)[-1]}


def test_quality_plan_has_no_python(spark, sf_dir, capsys):
    queries.QUERIES["op6_quality_rules"](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_shards(spark, sf_dir):
    out = queries.QUERIES["op4_rendezvous_shards"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, queries.SHARDS)
    for shard in range(queries.SHARDS):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    moved = sum(r.grown_shard != r.shard for r in out) / len(out)
    assert 0 < moved < 0.15
    # By hand: 52 bits of the MD5 of key and shard, the least score wins; slots follow the hash of the order columns.
    bits = lambda *parts: int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16)
    least = lambda key, n: min(range(n), key=lambda i: (-math.log((bits(key, i) + 0.5) / 2**52), i))
    assert all((r.shard, r.grown_shard) == (least(r.doc_id, queries.SHARDS), least(r.doc_id, queries.SHARDS + 1)) for r in out)
    for shard in range(queries.SHARDS):
        own = sorted((r for r in out if r.shard == shard), key=lambda r: r.slot)
        assert own == sorted(own, key=lambda r: (bits(r.doc_id, r.text_crc32, r.size), r.doc_id))


def test_shards_with_repeats_nulls_and_weights(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 3)
    monkeypatch.setattr(sharding, "GROUP_ROWS", 2)
    data = [(1, "a")] * 25 + [(None, "b")] * 4 + [(i, None) for i in range(30)]
    docs = spark.createDataFrame(data, "doc_id long, `group` string")
    placed = sharding.assign_shards(docs, "doc_id", [1.0, 1.0, 3.0], grown=[2.0])
    out = sharding.number_slots(placed, ["doc_id"], 3).collect()
    assert Counter((r.doc_id, r.group) for r in out) == Counter(data)
    for shard in range(3):
        own = sorted(r.slot for r in out if r.shard == shard)
        assert own == list(range(len(own)))
    assert len({r.shard for r in out if r.doc_id == 1}) == 1
    assert all(r.grown_shard in (r.shard, 3) for r in out)
    assert sharding.number_slots(placed.limit(0), ["doc_id"], 3).collect() == []
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit(1), [1.0, 0.0])


def test_weights_share_the_keys(spark):
    out = sharding.assign_shards(spark.range(20_000), "id", [1.0, 3.0]).groupBy("shard").count().collect()
    assert abs(dict(map(tuple, out))[1] / 20_000 - 0.75) < 0.02


def test_long_hosts_are_linear_in_their_labels(spark):
    """A host of half a million labels: only suffixes of as many labels as some rule has are made."""

    rules = spark.createDataFrame([("org", "/", "allow"), ("a.b.org", "", "block"), ("a.org", "/x", "block")], "host string, path string, action string")
    long = "a." * 500_000 + "org"
    pages = spark.createDataFrame([(1, f"http://{long}/x/y"), (2, "http://q.a.b.org"), (3, f"http://{'.' * 100_000}/x")], "page_id long, url string")
    for size in (256 << 20, 0):
        url_filter.filter_urls(pages.limit(0), rules, index_bytes=size).collect()
        started = time.perf_counter()
        got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules, index_bytes=size).collect()}
        assert time.perf_counter() - started < 30
        assert got == {1: ("a.org/x", "block"), 2: ("a.b.org", "block"), 3: (None, "allow")}
