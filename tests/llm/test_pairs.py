"""Prefix pieces, tokenizer alignment and spelling variants against the libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowsieve.llm import alignment, prefix_pieces, spelling

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a ▁b", "▁", "x\x1cy \x1c z", "  a", "a  ", " ", "\n", "\n\n a\t\tb", "<|endoftext|> <s></s>", "é　ü 　 x", "don't we'll \x85 q", "a\n b \n",
    "日本語 テキスト 🙂", "x);\r\n y\r z", "▁▁ a▁b  c", "a" * 3000, "tail ▁", "ok",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    with open(MODEL, "rb") as file:
        return prefix_pieces.PrefixCoder(file.read())


def encoded(coder, text):
    return [i for parts in coder.split(text) for p in parts for i in coder.part(p)]


# -- prefix pieces --------------------------------------------------------------


def test_joined_pieces_encode_as_the_library_does(coder, library):
    rng = random.Random(5)
    pieces = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    for _ in range(8000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))).replace("▁", rng.choice(" ▁"))
        assert encoded(coder, text) == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeinrst  \n▁.,\r"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_encodes_as_the_library_does(coder, library, text):
    assert encoded(coder, text) == library.encode(text)


def test_a_text_without_cuts_has_the_same_ids(coder):
    text = "▁" + cases.SENTENCE[:2000].replace(" ", "▁")
    assert coder.part(text) == encoded(coder, cases.SENTENCE[:2000])


def test_pieces_that_do_not_merge_to_themselves_are_never_last(coder):
    whole = [p for p in list(coder.score)[:3000] if coder.merges(p) is not None]
    assert all(coder.part(p) == [coder.pieces.index(p)] for p in whole[::40])


def test_round_trip_matches_library(spark, library):
    docs = cases.frame(spark, cases.rows(cases.TEXTS + ODD))
    got = {r.doc_id: tuple(r)[1:] for r in prefix_pieces.round_trip(docs, MODEL).collect()}
    for doc_id, text, *_ in cases.rows(cases.TEXTS + ODD):
        ids = [*library.encode(text or ""), 2]
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[doc_id] == (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))


def test_arrays_and_decoding_keep_other_columns(spark, library):
    docs = cases.frame(spark, cases.rows(cases.TEXTS + ODD)).withColumnRenamed("source", "decoded")
    out = prefix_pieces.decode_ids(prefix_pieces.encode_texts(docs, MODEL), MODEL, out="back").collect()
    assert len(out) == len(cases.TEXTS + ODD)
    for r in out:
        assert r.ids == [*library.encode(r.text or ""), 2] and r.back == library.decode(r.ids) and r.decoded == "src0"


def test_small_memory_gives_the_same(spark, coder, library, monkeypatch):
    monkeypatch.setattr(prefix_pieces, "CACHE_CHARS", 10)
    monkeypatch.setattr(prefix_pieces, "PAIRS", 3)
    monkeypatch.setattr(prefix_pieces, "SLICE", 2)
    known = prefix_pieces.Decimals(coder)
    text = "some words and some more words, again some words"
    assert " ".join(known[p] for parts in coder.split(text) for p in parts) == " ".join(map(str, library.encode(text)))


def test_pieces_on_empty_table_and_repeated_rows(spark):
    assert prefix_pieces.round_trip(cases.frame(spark, []), MODEL).collect() == []
    twice = cases.frame(spark, [(None, "same", None, None, None)] * 2)
    assert len(prefix_pieces.round_trip(twice, MODEL).collect()) == 2


def test_other_models_are_an_error(coder):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        prefix_pieces.PrefixCoder(proto.SerializeToString())
    with pytest.raises(ValueError):
        alignment.Sides(open(BYTE_LEVEL).read(), proto.SerializeToString())


# -- alignment ------------------------------------------------------------------


def aligned_by_hand(rows, library):
    """Links from all overlapping spans, groups from the common ends, counts over documents."""
    bpe = Tokenizer.from_file(BYTE_LEVEL)
    bpe.encode_special_tokens = True
    of_char = alignment.byte_table()
    entry = {i: bytes(of_char.get(c, 63) for c in name) for name, i in bpe.get_vocab().items()}
    piece = lambda i: bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()

    def spans(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends], ends))

    per, counts = [], Counter()
    for doc, text in rows:
        a = bpe.encode(" " + text, add_special_tokens=False).ids if text else []
        b = library.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        bytes_a, bytes_b = [entry[i] for i in a], [piece(i) for i in b]
        if not a or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            per.append((doc, [], [], [], []))
            continue
        spans_a, spans_b = spans(bytes_a), spans(bytes_b)
        links, low = [], 0
        for i, (start, end) in enumerate(spans_a):
            while spans_b[low][1] <= start:
                low += 1
            at = low
            while at < len(spans_b) and spans_b[at][0] < end:
                links.append((a[i], b[at]))
                at += 1
        ends_a, ends_b = {e: i for i, (_, e) in enumerate(spans_a)}, {e: i for i, (_, e) in enumerate(spans_b)}
        groups, i, j = [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            groups.append(",".join(map(str, a[i : ends_a[end] + 1])) + "|" + ",".join(map(str, b[j : ends_b[end] + 1])))
            i, j = ends_a[end] + 1, ends_b[end] + 1
        per.append((doc, a, b, links, groups))
        counts.update(set(links))
    top = defaultdict(int)
    for (first, _), n in counts.items():
        top[first] = max(top[first], n)
    return sorted((
        (doc, len(a), len(b), len(groups), len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        for doc, a, b, links, groups in per
    ), key=str)


def aligned(docs):
    return sorted(map(tuple, alignment.align_tokenizers(docs, BYTE_LEVEL, MODEL).collect()), key=str)


def test_alignment_matches_overlaps_by_hand(spark, library):
    data = cases.rows(cases.TEXTS + ODD) + [(None, "ok", None, None, None), (3, "ok", None, None, None)]
    docs = cases.frame(spark, data).withColumnRenamed("source", "chunk").withColumnRenamed("lang", "pair")
    assert aligned(docs) == aligned_by_hand([r[:2] for r in data], library)


def test_alignment_does_not_depend_on_chunks_or_memory(spark, library, monkeypatch):
    data = cases.rows(cases.TEXTS + ODD)
    sides = alignment.Sides(open(BYTE_LEVEL).read(), open(MODEL, "rb").read())
    whole = alignment.Aligned([" " + t for t in ODD], sides)
    monkeypatch.setattr(alignment, "UNITS", 3)
    memory = alignment.Memory(sides)
    for t in ODD:
        memory[" " + t]
    memory.align_new()
    assert memory.groups == whole.groups and memory.pairs.tolist()[: memory.starts[1]] == whole.pairs.tolist()[: whole.starts[1]]
    monkeypatch.setattr(alignment, "CHUNK", 100)  # read on the driver only where tasks are forked from it
    assert aligned(cases.frame(spark, data).repartition(3)) == aligned_by_hand([r[:2] for r in data], library)


def test_alignment_of_empty_table(spark):
    assert aligned(cases.frame(spark, [])) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab  \n\r;)▁'\x1c　"), st.characters(exclude_categories=["Cs"])), max_size=30), min_size=1, max_size=5))
def test_units_add_up_to_texts(library, texts):
    sides = _sides()
    for text in texts:
        units = sides.unit.findall(" " + text)
        assert "".join(units) == " " + text
        a, _ = sides.encode(units)
        assert [i for row in a.to_pylist() for i in row] == sides.a.encode(" " + text, add_special_tokens=False).ids
        if text and "▁" not in text:
            assert [i for row in sides.b.encode(units) for i in row] == library.encode(text)


def _sides(held=[]):  # noqa: B006  one for all examples
    if not held:
        held.append(alignment.Sides(open(BYTE_LEVEL).read(), open(MODEL, "rb").read()))
    return held[0]


# -- spelling -------------------------------------------------------------------


def one_edit(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) == len(u) + 1 and any(v[:k] + v[k + 1 :] == u for k in range(len(v)))


def variants_by_hand(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(cases.LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return grouped_by_hand({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def grouped_by_hand(counts):
    lists, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w) + 1):
            lists[w[:k] + w[k + 1 :]].add(w)
    for group in lists.values():
        for u, v in combinations(group, 2):
            if one_edit(u, v):
                near[u].add(v)
                near[v].add(u)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(st.sampled_from("abé"), min_size=1, max_size=7), min_size=1, max_size=60))
def test_scan_finds_all_pairs_of_a_sorted_list(words):
    words = sorted(words)
    sizes = np.array([len(w) for w in words])
    codes = np.array(words, f"<U{sizes.max()}").view(np.uint32).reshape(len(words), -1)
    a, b = spelling.near_pairs(codes, sizes, np.full(len(words), len(words)))
    found = list(zip(a.tolist(), b.tolist(), strict=True))
    assert len(found) == len(set(found))
    assert set(found) == {(i, j) for i, j in combinations(range(len(words)), 2) if one_edit(words[i], words[j])}


def test_scan_stays_within_lists():
    words = ["aa", "ab", "aa", "ab"]
    codes = np.array(words).view(np.uint32).reshape(4, -1)
    a, b = spelling.near_pairs(codes, np.full(4, 2), np.array([2, 2, 4, 4]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 1), (2, 3)]


@pytest.mark.parametrize("most", [2, 96])
def test_groups_match_brute_force(spark, most):
    rng = random.Random(3)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(400)}
    words |= {"intermediate" + w for w in list(words)[:60]} | {w + "ization" for w in list(words)[:60]} | {"x" * 3000, "x" * 2999, "y" + "x" * 2998}
    counts = {w: rng.choice([2, 3, 30, 400, 5000]) for w in words}
    got = spelling.group_words(spark.createDataFrame(list(counts.items()), "word string, n long"), most=most).collect()
    assert len(got) == len(counts)
    assert {r.word: tuple(r)[1:] for r in got} == grouped_by_hand(counts)


def test_variants_of_texts_match_brute_force(spark):
    texts = cases.TEXTS + ["Wonderful wonderfull WONDERFUL wonderfu wonderful " * 12, "übermäßig ubermäßig übermäßig×÷ ÜBERMÄSSIG " * 3, "onderful " * 2, "letters " * 9 + "lettres letters"]
    data = cases.rows(texts) + [(None, "wonderful keyless keyless", None, None, None)] * 2
    docs = cases.frame(spark, data).withColumnRenamed("source", "word").withColumnRenamed("lang", "key")
    got = {r.word: tuple(r)[1:] for r in spelling.spelling_variants(docs).collect()}
    assert got == variants_by_hand([r[:2] for r in data])
    assert any(v[0] for v in got.values())


def test_variants_of_empty_tables(spark):
    assert spelling.spelling_variants(cases.frame(spark, [])).collect() == []
    assert spelling.spelling_variants(cases.frame(spark, [(1, None, None, None, None), (2, "", None, None, None)])).collect() == []


def test_slices_of_runs_do_not_change_counts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 3)
    assert [r for part in spelling.runs_of("Abcdefgh abcdefg ABCDEFG ijklmnop qrstuvw short") for r in part] == ["abcdefgh", "abcdefg", "abcdefg", "ijklmnop", "qrstuvw"]
