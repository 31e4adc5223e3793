"""SimHash groups, line dedup and repeated passages against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flowsieve.llm import line_dedup, recompression, simhash
from flowsieve.llm.words import CHUNK, scan


def fingerprint(text):
    w = cases.words((text or "").translate(cases.LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_groups(spark):
    docs = cases.frame(spark).withColumnRenamed("source", "fp")
    prints = {i: fingerprint(t) for i, t, *_ in cases.rows()}
    want = groups(prints)
    for r in simhash.components_of(docs).collect():
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", want[r.doc_id])


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks()
    assert len(masks) == 15
    vectors = [1 + i % 15 for i in range(64)]
    for a in range(64):
        for b in range(a, 64):
            for c in range(b, 64):
                bits = 1 << a | 1 << b | 1 << c
                assert any(not m & bits for m in masks), (vectors[a], vectors[b], vectors[c])


@pytest.mark.parametrize("block", [4, 2048])
def test_links_connect_dense_buckets(spark, block):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    marks = {base, *(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(40)), *(rng.getrandbits(64) for _ in range(40))}
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    nodes = spark.createDataFrame([(m,) for m in signed], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(nodes, block=block)).collect()}
    want = groups(dict(zip(signed, [m & (2**64 - 1) for m in signed], strict=True)))
    assert {m: got.get(m, m) for m in signed} == want


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 100: 90}


def similarity(a, b):
    """Jaccard similarity of five-word shingles."""
    shingles = []
    for text in (a, b):
        w = (text or "").translate(cases.LOWER).encode().split()
        shingles.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    return len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1])


def check_near_copies(data, kept):
    """Equal texts leave one, nearly equal ones of some length too; what resembles nothing stays."""
    text = {i: t for i, t, *_ in data}
    for i in text:
        others = {j: similarity(text[i], text[j]) for j in text if j != i}
        if max(others.values(), default=0) < 0.6:
            assert i in kept
        if i in kept:
            assert not [j for j, s in others.items() if j in kept and (s == 1 or (s > 0.93 and len(cases.words(text[i])) > 60))]


def test_near_copies_are_found_and_others_stay(spark):
    rng = random.Random(5)
    rare = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    common = [rare() for _ in range(20)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else rare()
    data = []
    for g in range(30):
        base = [word() for _ in range(150)]
        data.append((len(data), " ".join(base), "en", "s", 0))
        for _ in range(g % 4):
            copy = list(base)
            copy[rng.randrange(150)] = word()
            data.append((len(data), " ".join(copy).title(), "en", "s", 0))
    kept = {r.doc_id for r in simhash.keep_one(cases.frame(spark, data)).collect()}
    text = {i: t for i, t, *_ in data}
    originals = {i for i in text if not any(similarity(text[i], text[j]) >= 0.6 for j in range(i))}
    assert len(originals) == 30 and originals <= kept  # what resembles nothing before it stays
    assert len(kept) <= 31  # of 45 near copies at most one is missed by the fingerprint's radius


def edited(rng, base, word, low, high):
    """A copy of the base with scattered words replaced until its similarity is within the bounds."""
    copy = list(base)
    while not low <= (now := similarity(" ".join(base), " ".join(copy))) < high:
        if now < low:
            copy = list(base)
        copy[rng.randrange(len(base))] = word()
    return " ".join(copy)


def test_near_copies_at_both_sides_of_the_limit(spark):
    rng = random.Random(11)
    rare = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    data, above, below = [], set(), set()
    for g in range(120):
        base = [rare() for _ in range(rng.choice([60, 150, 400]))]
        low, high = (0.8, 0.86) if g % 2 else (0.68, 0.8)
        data.append((len(data), " ".join(base), "en", "s", 0))
        (above if g % 2 else below).add(len(data))
        data.append((len(data), edited(rng, base, rare, low, high), "en", "s", 0))
    kept = {r.doc_id for r in simhash.keep_one(cases.frame(spark, data)).collect()}
    assert not kept & above and below <= kept
    assert kept == set(range(240)) - above


@pytest.mark.parametrize("size", [30, 80, 150, 400])
def test_candidates_meet_at_every_length(size):
    rng = random.Random(size)
    common = [f"w{i}" for i in range(300)]
    word = lambda: rng.choice(common)
    made = lambda text: simhash.bands(simhash.shingles(scan([text.encode()]).hashes))
    for _ in range(60):
        base = [word() for _ in range(size)]
        assert (made(" ".join(base)) == made(edited(rng, base, word, 0.8, 0.87))).any()


@pytest.mark.parametrize(("most", "small"), [(0, 0), (0, 16), (4, 16)])
def test_near_groups_are_connected_through_their_links(spark, monkeypatch, most, small):
    monkeypatch.setattr(simhash, "NEAR_PAIRS", most)
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(3)
    rare = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    texts = []
    for _ in range(6):
        chain = [rare() for _ in range(120)]
        for _ in range(8):
            texts.append(" ".join(chain))
            for _ in range(2):
                chain[rng.randrange(120)] = rare()
    rng.shuffle(texts)
    root = list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            if similarity(texts[i], texts[j]) >= 0.8 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    data = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    assert {r.doc_id for r in simhash.keep_one(cases.frame(spark, data)).collect()} == set(root)


def sets_frame(spark, sets, roots=None):
    rows = [(i, i if roots is None else roots[i], sorted(s)) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "node long, root long, grams array<long>")


@pytest.mark.parametrize("one_component", [False, True])
def test_rare_shingles_lose_no_similar_pair(spark, one_component):
    rng = random.Random(9)
    template = set(range(1000, 1060))
    sets = []
    for _ in range(40):
        base = {rng.randrange(300) for _ in range(rng.randint(1, 60))} | (template if rng.random() < 0.5 else set())
        sets.append(base)
        for _ in range(3):
            near = {g for g in base if rng.random() > 0.08} | {rng.randrange(5000, 9000) for _ in range(rng.randint(0, 6))}
            sets.append(near or base)
    roots = [0 if one_component and i % 4 else i for i in range(len(sets))]
    got = {tuple(sorted(r)) for r in simhash.rare_pairs(sets_frame(spark, sets, roots)).collect()}
    for i, j in combinations(range(len(sets)), 2):
        if roots[i] != roots[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            assert (i, j) in got
    assert all(roots[i] != roots[j] for i, j in got)


def test_texts_of_one_template_make_few_pairs(spark, monkeypatch):
    """1,200 texts of 60 shared and 12 own words, below 0.8: their rare shingles differ, so they hardly meet."""
    shared, compared = [f"shared{i}" for i in range(60)], []
    data = [(n, " ".join([*shared, *(f"own{n}x{k}" for k in range(12))]), "en", "s", 0) for n in range(1200)]
    alike = simhash.alike

    def counted(pairs, sets):
        compared.append(pairs.count())
        return alike(pairs, sets)

    monkeypatch.setattr(simhash, "alike", counted)
    assert simhash.keep_one(cases.frame(spark, data)).count() == 1200
    assert sum(compared) < 20_000 and compared[-1] == 0


def test_one_of_each_group_stays(spark):
    data = cases.rows() + [(0, cases.TEXTS[0], "en", "s", 1), (None, cases.TEXTS[0], "en", "s", 1), (None, "no id here at all", "en", "s", 1), (None, "no id here at all", "en", "s", 1)]
    docs = cases.frame(spark, data).withColumnRenamed("source", "ident").withColumnRenamed("lang", "loser")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows if r.doc_id is not None]
    assert len(ids) == len(set(ids))
    check_near_copies(cases.rows(), set(ids))
    assert [r.text for r in rows if r.doc_id is None] == ["no id here at all"]
    assert simhash.keep_one(docs.limit(0)).collect() == [] and simhash.components_of(docs.limit(0)).collect() == []


def test_other_texts_of_a_repeated_key_stay(spark):
    other = " ".join(f"other{i}" for i in range(90))
    data = [(1, cases.SENTENCE, "en", "s", 0), (5, cases.SENTENCE + " end", "en", "s", 0), (5, other, "en", "s", 0), (6, other, "en", "s", 0), (6, other.upper() + " end", "en", "s", 0)]
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one(cases.frame(spark, data)).collect())
    assert kept == [(1, cases.SENTENCE), (5, other)]


def line_result(data, min_chars=40, min_docs=5):
    key = lambda line: line.strip(cases.BLANKS).translate(cases.LOWER)
    holders = {}
    for i, text, *_ in data:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, text, *_ in data:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_lines(spark):
    docs = cases.frame(spark).withColumnRenamed("source", "digests").withColumnRenamed("lang", "who")
    want = line_result(cases.rows())
    assert any(w[2] for w in want.values())
    got = line_dedup.dedup_lines(docs).collect()
    assert {r.doc_id: (r.kept_text, r.n_lines, r.n_dropped) for r in got} == want and len(got) == len(want)
    assert line_dedup.without_repeated_lines(docs).columns == docs.columns
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def test_null_ids_and_repeated_rows_in_lines(spark):
    data = [(None, cases.LINE, None, None, None)] * 2 + [(i, cases.LINE, None, None, None) for i in (1, 1, 2, 3)]
    out = line_dedup.dedup_lines(cases.frame(spark, data)).collect()  # four documents: three ids and the missing one
    assert all(r.n_dropped == 0 for r in out) and len(out) == 6
    out = line_dedup.dedup_lines(cases.frame(spark, [*data, (4, cases.LINE, None, None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in out) == [(0, 1), (0, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 0)]


def test_line_index_is_reversible(spark):
    rows = cases.rows()
    first, second = cases.frame(spark, rows[:14]), cases.frame(spark, rows[14:])
    state = lambda index: (sorted((bytes(r.digest), r.docs, r.largest) for r in index.counts.collect()), sorted(map(str, index.drops().collect())))
    one = line_dedup.LineIndex().insert(first)
    both = one.insert(second)
    assert state(both) == state(line_dedup.LineIndex().insert(cases.frame(spark)))
    assert state(both.insert(second)) == state(both)
    assert state(both.delete(second)) == state(one)
    assert not [t for r in both.delete(second).delete(first).filters.collect() for t in r.tables if any(t)]


def test_cuckoo_filter_inserts_and_deletes():
    rng = np.random.default_rng(3)
    digests = rng.integers(0, 1 << 63, (3000, 2), dtype=np.uint64)
    own = line_dedup.Cuckoo(expected=64)  # too small, so further tables follow
    own.insert(digests)
    assert own.contains(digests).all() and len(own.tables) > 1
    assert line_dedup.Cuckoo.load(own.dump()).contains(digests).all()
    assert own.contains(rng.integers(0, 1 << 63, (3000, 2), dtype=np.uint64)).mean() < 0.02
    own.delete(digests[:1500])
    assert own.contains(digests[1500:]).all()
    own.delete(digests[1500:])
    assert not any(t.any() for t in own.tables)


def repeat_result(data, window=20):
    found, out = {}, []
    order = lambda i: -1 if i is None else i
    for i, text, *_ in data:
        w = cases.words(text)
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            found[g] = min(found.get(g, (1 << 60, 0)), (order(i), s))
    for i, text, *_ in data:
        w = cases.words(text)
        gone = {s + k for s in range(len(w) - window + 1) if found[tuple(w[s : s + window])] < (order(i), s) for k in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def test_repeats(spark):
    docs = cases.frame(spark).withColumnRenamed("source", "id").withColumnRenamed("lang", "crc")
    want = repeat_result(cases.rows())
    assert sum(w[2] > 0 for w in want) > 3
    assert sorted(map(tuple, recompression.remove_repeats(docs).collect()), key=str) == want
    assert recompression.remove_repeats(docs.limit(0)).collect() == []


def test_repeats_with_null_and_repeated_ids(spark):
    data = [(None, cases.SENTENCE), (5, cases.SENTENCE), (5, cases.SENTENCE), (5, "x " + cases.SENTENCE), (2, "q " * 70)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted(map(tuple, recompression.remove_repeats(docs).collect()), key=str) == repeat_result(data)


@pytest.mark.parametrize("seed", range(4))
def test_repeats_on_random_texts_of_few_words(spark, seed):
    """Few different words make runs, periods and ties of names frequent."""
    rng = random.Random(seed)
    letters = ["a", "b"] if seed % 2 else ["a", "b", "c", "d", "e", "f"]
    passage = [rng.choice(letters) for _ in range(60)]
    data = []
    for i in range(30):
        w = [rng.choice(letters) for _ in range(rng.randrange(60))]
        a = rng.randrange(40)
        data.append((i, " ".join(w[:20] + passage[a : a + rng.randrange(15, 60)] + w[20:])))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted(map(tuple, recompression.remove_repeats(docs).collect()), key=str) == repeat_result(data)


@pytest.mark.parametrize("window", [4, 20, 50])
def test_equal_windows_have_equal_anchors(window):
    rng = np.random.default_rng(window)
    rounds, unit = recompression.rounds_for(window)
    core = rng.integers(0, 40, window).astype(np.uint64)
    names_of = set()
    for _ in range(200):
        left, right = rng.integers(0, 40, rng.integers(0, 60)), rng.integers(0, 40, rng.integers(0, 60))
        words = np.concatenate([left, core, right]).astype(np.uint64)
        names, starts = recompression.parse(words, np.array([0, len(words)]), rounds)
        units, begins, best = recompression.anchors(names, starts, np.array([0, len(words)]), window, rounds, unit)
        at = best[begins == len(left)][0]
        names_of.add((int(units[at]), int(starts[at]) - len(left)))
    assert len(names_of) == 1


def test_scan_finds_words_and_hashes():
    texts = [(t or "").encode() for t in cases.TEXTS] + [b"w" * (CHUNK + 5) + b" end", b"a b " * (CHUNK // 3)]
    got = scan(texts)
    flat = [w for t in texts for w in t.split()]
    assert got.offsets.tolist() == np.cumsum([0, *[len(t.split()) for t in texts]]).tolist()
    named = {}
    for w, h in zip(flat, got.hashes.tolist(), strict=True):
        assert named.setdefault(w, h) == h
    assert len(set(named.values())) == len(named)
    assert got.last.tolist() == [w[-1] for w in flat] and got.first.tolist() == [w[0] for w in flat]


def test_near_copies_of_the_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check_near_copies(data, {r.doc_id for r in simhash.keep_one(docs).collect()})


def test_fingerprints_lead_the_near_copies(spark):
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base), " ".join([*base[:-1], "other"]), " ".join(base[::-1]), "", " ".join(f"v{i}" for i in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    prints = simhash.fingerprints(docs, "node")
    marks = {r["node"]: r["fp"] & (2**64 - 1) for r in prints.collect()}
    pairs = {tuple(sorted(r)) for r in simhash.print_pairs(prints).collect()}
    near = {(a, b) for a in marks for b in marks if a < b and (marks[a] ^ marks[b]).bit_count() <= simhash.RADIUS}
    assert (0, 1) in near and pairs == near
    # Links by fingerprint stand by themselves, without a band in common.
    none = spark.createDataFrame([], "key long, node long")
    sets = spark.createDataFrame([], "node long, grams array<long>")
    found = simhash.near_components(none, sets, first=simhash.print_pairs(prints))
    assert {r["node"]: r["root"] for r in found.collect()} == {0: 0, 1: 0}


def test_texts_with_connected_fingerprints_are_all_compared(spark, monkeypatch):
    """Links that span a component lead from text to text that need not be alike; others of it are, and share no band here."""
    base = [" ".join(f"g{g}w{i}" for i in range(60)) for g in range(8)]
    data = [(n, f"{base[n // 3]} end{n}", "en", "s", 0) for n in range(24)]
    monkeypatch.setattr(simhash, "fingerprints", lambda df, key: df.select(key, F.lit(0).cast("long").alias("fp")))
    monkeypatch.setattr(simhash, "bands", lambda grams: grams.sum(keepdims=True))
    for most, small in ((4, 24), (0, 16)):
        monkeypatch.setattr(simhash, "NEAR_PAIRS", most)
        monkeypatch.setattr(simhash, "SMALL", small)
        assert {r.doc_id for r in simhash.keep_one(cases.frame(spark, data)).collect()} == {3 * g for g in range(8)}
