"""Benchmark decontamination by templates.

Texts become templates: numbers, units and names turn into typed placeholders,
other words into lower case. Windows of template words are looked up in a hash
table of all benchmark windows. An item counts as leaked when enough of its
windows appear in order within a span of the document, the template words
around them cover enough of the whole item, and the values in its slots map one
to one to the document's values; so a question asked again with other names and
numbers is found, and chance matches of mere templates are not.

Items of few such windows (one or two words, arithmetic, lists of names, scripts
without blanks) are also looked for as they stand: windows of lower-cased words,
signs of arithmetic and, in such scripts, characters, without placeholders. An
item of one word leaks wherever that word stands.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.llm.words import mix

WINDOW, SIMILARITY = 5, 0.8
#: Words of a window that must be no placeholders; slots that must agree.
LITERALS, CONSISTENT = 3, 0.8
#: A match spans at most this many times the item's words, and so many words more. The close span is tried first.
SPANS, MORE = (1, 3), 8
#: Benchmark text that is broadcast at once; a larger benchmark takes several passes.
BLOCK_BYTES = 16 << 20
#: Cached tokens of a worker.
CACHE = 150_000

# Words and signs that are units after (or, for signs, next to) a number, and words that are numbers.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres mg g kg t oz lb lbs gram grams "
    "kilogram kilograms ton tons ml l liter liters litre litres s ms sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years dollar dollars cent cents euro euros pound pounds percent degree degrees kb mb gb tb hz khz "
    "mhz ghz w kw kwh v a j cal kcal mph kmh kph".split()
)
SIGNS = frozenset("%$€£¥°")
NUMBERS = frozenset(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)

_TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[.!?\n]|[%$€£¥°]")
LITERAL, NAME, NUMBER, UNIT, STOP, SIGN = range(6)
#: Words as they stand: signs of arithmetic, characters of scripts without blanks, other words.
_EXACT = re.compile(r"[-+*/=<>^%×÷−]|[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
                    r"|[^\W_\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
_PLACE = mix(np.arange(1, 5, dtype=np.uint64))


class Template(NamedTuple):
    words: np.ndarray  # template word of each token
    kinds: np.ndarray
    values: np.ndarray  # hash of what stood there
    text: str = ""


class _Codes(dict):
    """Code of each token, made when first asked for; bounded."""

    def __missing__(self, token: str) -> int:
        low = token.lower()
        first = token[0]
        if first in ".!?\n":
            kind = STOP
        elif first in SIGNS:
            kind = SIGN
        elif first.isdigit() or low in NUMBERS:
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = NAME if first.isupper() and not (len(token) > 1 and token.isupper()) else LITERAL
        got = int.from_bytes(hashlib.blake2b(low.encode(), digest_size=8).digest(), "little") >> 3 << 3 | kind
        if len(self) >= CACHE:
            self.clear()
        self[token] = got
        return got


class Reader:
    """Turns texts into templates; a bounded cache holds the code of each token."""

    def __init__(self):
        self.cache = _Codes()
        self.code = self.cache.__getitem__

    def read(self, text: str) -> Template:
        tokens = _TOKEN.findall(text)
        codes = np.fromiter(map(self.code, tokens), np.uint64, len(tokens))
        kinds, values = (codes & np.uint64(7)).astype(np.int8), codes >> np.uint64(3)
        before = np.concatenate([[STOP], kinds[:-1]])[: len(kinds)]
        kinds = np.where((kinds == NAME) & (before == STOP), LITERAL, kinds)  # a capital that only opens a sentence
        kinds = np.where((kinds == UNIT) & (before != NUMBER), LITERAL, np.where(kinds == SIGN, UNIT, kinds))
        before = np.concatenate([[STOP], kinds[:-1]])[: len(kinds)]
        stay = (kinds != STOP) & ~((kinds == NAME) & (before == NAME))  # a name of several words is one slot
        group = np.cumsum(stay) - 1
        name = (kinds == NAME) & (group >= 0)
        whole = np.zeros(int(stay.sum()), np.uint64)
        np.add.at(whole, group[name], mix(values[name]))
        kinds, values = kinds[stay], values[stay]
        values = np.where(kinds == NAME, whole, values)
        words = np.where(kinds == LITERAL, values, _PLACE[np.clip(kinds, 0, 3)])
        return Template(words, kinds, values, text)

    def exact(self, text: str) -> Template:
        """The text as it stands, all words literal."""
        values = np.fromiter(map(self.code, _EXACT.findall(text)), np.uint64) >> np.uint64(3)
        return Template(values, np.full(len(values), LITERAL, np.int8), values)


def windows(got: Template, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of the template, and whether it has enough words that are no placeholders."""
    count = max(0, len(got.words) - size + 1)
    out, literal = np.zeros(count, np.uint64), np.zeros(count, np.int64)
    for k in range(size if count else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + got.words[k : k + count]
        literal += got.kinds[k : k + count] == LITERAL
    return mix(out + np.uint64(size)), literal >= LITERALS


class Items(NamedTuple):
    """All windows of a block of the benchmark, in order of hash."""

    keys: np.ndarray
    item: np.ndarray
    at: np.ndarray
    ids: list
    templates: list[Template]
    sizes: np.ndarray
    totals: np.ndarray
    exact: Items | None = None  # those of few usable windows, as they stand


def build_items(rows: list[tuple], window: int = WINDOW) -> Items:
    reader, ids, templates, sizes, totals, parts, short = Reader(), [], [], [], [], [], []
    for ident, text in rows:
        got = reader.read(text or "")
        size = min(window, len(got.words))
        keys, usable = windows(got, size) if size else (np.zeros(0, np.uint64), np.zeros(0, bool))
        first = _TOKEN.search(text or "")
        if first and reader.code(first.group()) & 7 == NAME and usable[1:].any():
            usable[:1] = False  # in a document the capital may stand inside a sentence and read as a name
        at = np.flatnonzero(usable)
        if len(np.unique(at[:, None] + np.arange(size))) < SIMILARITY * len(got.words) or not len(at):
            short.append((ident, text or ""))
        if not len(at):
            continue
        parts.append((keys[at], np.full(len(at), len(ids)), at))
        ids.append(ident)
        templates.append(got)
        sizes.append(size)
        totals.append(len(at))
    return _table(parts, ids, templates, sizes, totals)._replace(exact=_exact_items(reader, short, window))


def _exact_items(reader: Reader, rows: list[tuple], window: int) -> Items | None:
    """All windows of items as they stand; None if no item has a word."""
    ids, templates, sizes, totals, parts = [], [], [], [], []
    for ident, text in rows:
        got = reader.exact(text)
        size = min(window, len(got.words))
        if size:
            keys, _ = windows(got, size)
            parts.append((keys, np.full(len(keys), len(ids)), np.arange(len(keys))))
            ids.append(ident)
            templates.append(got)
            sizes.append(size)
            totals.append(len(keys))
    return _table(parts, ids, templates, sizes, totals) if ids else None


def _table(parts: list[tuple], ids: list, templates: list[Template], sizes: list[int], totals: list[int]) -> Items:
    keys, item, at = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.argsort(keys, kind="stable")
    return Items(keys[order], item[order], at[order], ids, templates, np.array(sizes), np.array(totals))


def leaks(got: Template, items: Items, similarity: float = SIMILARITY) -> list[tuple]:
    """(item, matched windows, all windows, slots, slots with the item's own value) of the items that the text leaks."""
    found = _leaks(got, items, similarity)
    if items.exact is not None and got.text:
        seen = {x[0] for x in found}
        found += [x for x in _leaks(_reader().exact(got.text), items.exact, similarity) if x[0] not in seen]
    return found


def _leaks(got: Template, items: Items, similarity: float) -> list[tuple]:
    found: list[tuple] = []
    if not len(items.keys):
        return found
    hits = []
    for size in np.unique(items.sizes):
        keys, _ = windows(got, int(size))
        low = np.searchsorted(items.keys, keys)
        at = np.flatnonzero((low < len(items.keys)) & (items.keys[np.minimum(low, len(items.keys) - 1)] == keys))
        if len(at):
            many = np.searchsorted(items.keys, keys[at], side="right") - low[at]
            entry = np.repeat(low[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
            hits.append((items.item[entry], items.at[entry], np.repeat(at, many)))
    if not hits:
        return found
    item, own, here = (np.concatenate(c) for c in zip(*hits, strict=True))
    order = np.lexsort((-own, here, item))  # of the windows at one place a rising chain takes one
    item, own, here = item[order], own[order], here[order]
    cuts = np.flatnonzero(np.diff(item, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        i = int(item[a])
        distinct = np.unique(own[a:b])
        if len(distinct) < similarity * items.totals[i]:
            continue
        late = distinct[len(distinct) - max(1, int(np.ceil(similarity * items.totals[i])))]  # a chain that starts later is too short
        best = _best_chain(got, items, i, own[a:b], here[a:b], int(late), similarity)
        if best:
            found.append((items.ids[i], best[0], int(items.totals[i]), best[1], best[2]))
    return found


def _best_chain(got: Template, items: Items, i: int, own: np.ndarray, here: np.ndarray, late: int, similarity: float) -> tuple | None:
    """(matched windows, slots, slots with the item's own value) of the best chain of the item's windows, or None.

    A chain rises in the item and in the document. What is put between its
    windows does not matter, as long as the whole lies within the span.
    """
    need, total, template, size = similarity * items.totals[i], int(items.totals[i]), items.templates[i], int(items.sizes[i])
    best: tuple | None = None
    tried: set[tuple] = set()
    for start in np.flatnonzero(own <= late):
        for span in SPANS:
            stop = int(np.searchsorted(here, here[start] + span * len(template.words) + MORE, side="right"))
            if stop - start < need or len(np.unique(own[start:stop])) < need:
                continue
            chain = start + _rising(own[start:stop])
            if len(chain) < need or (best and len(chain) <= best[0]) or (int(chain[0]), int(chain[-1])) in tried:
                continue
            tried.add((int(chain[0]), int(chain[-1])))
            slots, same, agree, share = _slots(got, template, own[chain], here[chain], size)
            if agree and share >= similarity:
                best = (len(chain), slots, same)
        if best and best[0] == total:
            break
    return best


def _rising(values: np.ndarray) -> np.ndarray:
    """Places of the longest strictly rising chain."""
    ends: list[int] = []
    places: list[int] = []
    before = []
    for place, value in enumerate(values.tolist()):
        k = bisect_left(ends, value)
        before.append(places[k - 1] if k else -1)
        ends[k : k + 1] = [value]
        places[k : k + 1] = [place]
    out, place = [], places[-1]
    while place >= 0:
        out.append(place)
        place = before[place]
    return np.array(out[::-1])


def _slots(got: Template, item: Template, own: np.ndarray, here: np.ndarray, size: int) -> tuple[int, int, bool, float]:
    """Slots under the match, how many hold the item's own value, whether values map one to one, and the share of the item covered.

    The match is the matched windows and the equal template words before, between and after them.
    """
    left, right = (own[:, None] + np.arange(size)).ravel(), (here[:, None] + np.arange(size)).ravel()
    more: list[tuple[int, int]] = []
    ends = [(-size, max(-size, int(here[0] - own[0]) - size)), *zip(own.tolist(), here.tolist(), strict=True), (len(item.words), len(got.words))]
    for k, ((a, x), (b, y)) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        a, x = a + size, x + size
        if k in (0, len(ends) - 2) or b - a == y - x:  # at one shift, unequal words do not end the match
            shift = y - b if k < len(ends) - 2 else x - a
            more.extend((p, p + shift) for p in range(max(a, 0), b) if 0 <= p + shift < len(got.words) and item.words[p] == got.words[p + shift])
            continue
        while a < b and x < y and item.words[a] == got.words[x]:
            more.append((a, x))
            a, x = a + 1, x + 1
        while b > a and y > x and item.words[b - 1] == got.words[y - 1]:
            b, y = b - 1, y - 1
            more.append((b, y))
    pairs = np.unique(np.concatenate([np.stack([left, right], 1), np.array(more, np.int64).reshape(-1, 2)]), axis=0)
    share = len(np.unique(pairs[:, 0])) / len(item.words)
    pairs = pairs[item.kinds[pairs[:, 0]] != LITERAL]
    if not len(pairs):
        return 0, 0, True, share
    left, right = item.values[pairs[:, 0]], got.values[pairs[:, 1]]
    agree = min(_main_share(left, right), _main_share(right, left))
    return len(np.unique(pairs[:, 0])), int((left == right).sum()), agree >= CONSISTENT, share


def _main_share(given: np.ndarray, other: np.ndarray) -> float:
    """Share of pairs in which a value has the partner that it has most often."""
    pair, times = np.unique(np.stack([given, other], 1), axis=0, return_counts=True)
    main: dict = {}
    for value, n in zip(pair[:, 0].tolist(), times.tolist(), strict=True):
        main[value] = max(main.get(value, 0), n)
    return sum(main.values()) / len(given)


def benchmark_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The texts of the benchmark, each once, in blocks of bounded size; each block comes to the driver and is broadcast in turn.

    Items are named by the hash of their text; their ids, however many a text has, are joined to what is found.
    """
    rows = benchmark.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).distinct().select(F.xxhash64("text").alias("id"), "text")
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    for b in range(blocks):
        part = rows if blocks == 1 else rows.filter(F.pmod(F.col("id"), F.lit(blocks)) == b)
        yield build_items([tuple(r) for r in part.collect()])


_READERS: list[Reader] = []


def _reader() -> Reader:
    if not _READERS:
        _READERS.append(Reader())
    return _READERS[0]


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row per document and item that it leaks: key, item, n_matched, n_windows, n_slots, n_same_values.

    Null and empty texts leak nothing, and items without a word are not recognised. Repeated rows give repeated results. Documents are read
    whole and not shuffled.
    """
    narrow = docs.select(F.col(f"`{key}`").alias("a"), F.col(f"`{text}`").alias("b"))
    names = [key, item_key, "n_matched", "n_windows", "n_slots", "n_same_values"]
    ids = benchmark.select(F.col(f"`{item_key}`").alias("item"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("of"))
    schema = T.StructType([
        T.StructField("doc", docs.schema[key].dataType), T.StructField("of", T.LongType()), T.StructField("n_matched", T.LongType()),
        T.StructField("n_windows", T.LongType()), T.StructField("n_slots", T.LongType()), T.StructField("n_same_values", T.LongType()),
    ])
    out = None
    for items in benchmark_blocks(benchmark, item_key):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            reader, own = _reader(), shared.value
            for batch in batches:
                found, at = [], []
                for i, row in enumerate(batch.column("b")):
                    got = leaks(reader.read(row.as_py() or ""), own)
                    found.extend(got)
                    at.extend([i] * len(got))
                columns = list(zip(*found, strict=True)) or [()] * 5
                keys = batch.column("a").take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, pa.int64()) for c in columns]], names=schema.names)

        part = narrow.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out.join(ids, "of").select("doc", "item", "n_matched", "n_windows", "n_slots", "n_same_values").toDF(*names)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that leak no item, in the columns they came with. No join: each block filters what the last one left."""
    out = docs
    for items in benchmark_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            reader, own = _reader(), shared.value
            for batch in batches:
                clean = [not leaks(reader.read(row.as_py() or ""), own) for row in batch.column(text)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
