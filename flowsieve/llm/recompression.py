"""Repeated passages by recompression.

Rounds of pair compression name adjacent symbols by a hash of their names. In
each round a symbol is a left or a right one by a bit of its name, and a left
one joins a right one behind it. Whether two neighbours join depends on them
alone, so equal passages get equal symbols inside; only one symbol at each end
can differ in a round. Names are hashes, hence global without coordination; a
run of one symbol keeps that symbol's name throughout, because naming its
length would let words outside a passage decide about its inside.

After r rounds a window of w words keeps whole symbols in its middle, of
w - 2 (2**r - 1) words at least, equal wherever the window occurs. A few
neighbouring symbols there form a unit; the least unit is the window's anchor.
Spark counts anchors over the corpus; only windows whose anchor is shared are
then compared, by 96 bits, and all but the first occurrence go.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.llm.common import slices
from flowsieve.llm.words import mix, scan

WINDOW = 20
#: Text handled at once in a worker, and words of the corpus per bucket: both bound the memory of a task.
BYTES_AT_ONCE, WORDS_PER_BUCKET = 2 << 20, 1 << 21
#: Place of rows without an id in the order of documents: before all others.
NO_ID = -(1 << 63)
_DEALT = "bucket int, local boolean, data binary"


def rounds_for(window: int) -> tuple[int, int]:
    """Rounds, and symbols in a unit: as many as the middle of every window holds, whose loss stays below a third."""
    r = 0
    while 6 * ((1 << (r + 1)) - 1) <= window:
        r += 1
    middle = window - 2 * ((1 << r) - 1)
    return r, -(-middle // (1 << r))


def parse(hashes: np.ndarray, offsets: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Names and first words of the symbols of all texts after the rounds. Symbols stay inside their text."""
    names, starts = hashes, np.arange(len(hashes))
    first = np.zeros(len(hashes) + 1, bool)
    first[offsets] = True
    for r in range(rounds):
        if len(names) < 2:
            break
        right = (mix(names ^ np.uint64(0x9E37 + r)) & np.uint64(1)).astype(bool)
        join = ~right[:-1] & right[1:] & ~first[starts[1:]]
        at = np.flatnonzero(join)
        made = mix(names[at] * np.uint64(0x9E3779B97F4A7C15) + mix(names[at + 1] + np.uint64(r + 1)))
        names = names.copy()
        names[at] = made
        stay = np.ones(len(names), bool)
        stay[at + 1] = False
        names, starts = names[stay], starts[stay]
    return names, starts


def anchors(names: np.ndarray, starts: np.ndarray, offsets: np.ndarray, window: int, rounds: int, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the units, first words of all windows, and each one's anchor: the least unit in its middle, the leftmost of equals.

    Unit i is named by the symbols i to i + unit - 1.
    """
    words = int(offsets[-1])
    units = np.zeros(max(0, len(names) - unit + 1), np.uint64)
    for k in range(unit):
        units = units * np.uint64(0x9E3779B97F4A7C15) + names[k : k + len(units)]
    units = mix(units)
    begins = np.arange(max(0, words - window + 1))
    owner = np.zeros(words + 1, np.int64)
    np.add.at(owner, offsets[1:-1], 1)  # texts without words share an offset
    text = np.cumsum(owner)[:-1]
    begins = begins[text[begins] == text[begins + window - 1]] if len(begins) else begins
    lost = (1 << rounds) - 1
    symbol = np.zeros(words, np.int64)
    symbol[starts[1:]] = 1
    symbol = np.cumsum(symbol)
    best, last = symbol[begins + lost], symbol[begins + window - lost - 1] - unit + 1
    low = units[best]
    at = best.copy()
    while (more := np.minimum(at + 1, last)).size and (more > at).any():
        at = more
        value = units[at]
        less = value < low
        best[less], low[less] = at[less], value[less]
    return units, begins, best


def window_hashes(hashes: np.ndarray, begins: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes, of 64 and 32 bits, of the windows that begin at the given words."""
    count = max(0, len(hashes) - window + 1)
    one, two = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    for k in range(window):
        one = one * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
        two = two * np.uint64(0xD6E8FEB86659FD93) + (hashes[k : k + count] >> np.uint64(7))
    return mix(one[begins]), (mix(two[begins]) >> np.uint64(32)).astype(np.uint32)


def _planes(values: np.ndarray) -> bytes:
    """Differences of a column, byte by byte of equal weight, so that block compression can shrink them."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplane(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel(), dtype=kind)


def _pack(names: np.ndarray, check: np.ndarray, doc: np.ndarray, mark: np.ndarray, place: np.ndarray) -> bytes:
    return b"".join([np.int64(len(doc)).tobytes(), names.tobytes(), check.tobytes(), _planes(mark), _planes(doc), _planes(place)])


def _unpack(raw: bytes) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    cuts = np.cumsum([8, 8 * n, 4 * n, 4 * n, 8 * n, 4 * n])
    part = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return (
        np.frombuffer(part[0], np.uint64), np.frombuffer(part[1], np.uint32), _unplane(part[3], np.int64),
        _unplane(part[2], np.uint32), _unplane(part[4], np.int32),
    )


def _deal(buckets: int, names: np.ndarray, own: tuple[np.ndarray, ...], local: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """Rows for the buckets by name of the anchor, and one row with what is already settled here."""
    bucket = (names % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    rows = [(int(bucket[order[a]]), False, _pack(*[c[order[a:b]] for c in own])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    if len(local[0]):
        unnamed = (np.zeros_like(local[0]), np.zeros_like(local[1]))
        rows.append((int(local[0][0] % np.uint64(buckets)), True, _pack(*unnamed, *local[2:])))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.binary())],
        names=["bucket", "local", "data"],
    )


def _groups(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows in groups of bounded text size, with the texts as bytes."""
    for rows in slices(batches, text, BYTES_AT_ONCE):
        yield rows, [(row.as_py() or "").encode() for row in rows.column(text)]


def _shared_anchors(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """(id, places): per document the first words of anchors that occur more than once in the corpus."""
    rounds, unit = rounds_for(window)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raws in _groups(batches, "text"):
            found = scan(raws)
            names, starts = parse(found.hashes, found.offsets, rounds)
            names, _, best = anchors(names, starts, found.offsets, window, rounds, unit)
            used = np.zeros(len(names), bool)
            used[best] = True
            at = np.flatnonzero(used)
            if not len(at):
                continue
            row = np.searchsorted(found.offsets, starts[at], side="right") - 1
            doc, place = rows.column("id").to_numpy(zero_copy_only=False)[row], (starts[at] - found.offsets[row]).astype(np.int32)
            _, one, count = np.unique(names[at], return_index=True, return_counts=True)
            again = np.ones(len(at), bool)
            again[one[count == 1]] = False  # occurs more than once here, so it is shared already
            none = np.zeros(len(at), np.uint32)
            columns = (names[at], none, doc, none, place)
            one.sort()
            yield _deal(buckets, names[at[one]], tuple(c[one] for c in columns), tuple(c[again] for c in columns))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, _, doc, _, place, local in _by_bucket(batches):
            _, back, count = np.unique(names, return_inverse=True, return_counts=True)
            keep = local | (count[back] > 1)
            yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(place[keep])], names=["id", "place"])

    dealt = docs.select("id", "text").mapInArrow(emit, _DEALT)
    return _bucketed(dealt).mapInArrow(share, "id long, place int").groupBy("id").agg(F.collect_list("place").alias("places"))


def _bucketed(dealt: DataFrame) -> DataFrame:
    return dealt.repartition("bucket").sortWithinPartitions("bucket")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of each bucket, put together from its packed rows, with the flag of rows settled before."""
    held: list[tuple] = []
    bucket = None
    for batch in batches:
        for b, local, data in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            if held and b != bucket:
                yield _merged(held)
                held = []
            bucket = b
            held.append((*_unpack(data), local))
    if held:
        yield _merged(held)


def _merged(held: list[tuple]) -> tuple[np.ndarray, ...]:
    local = np.repeat([h[5] for h in held], [len(h[0]) for h in held])
    return (*[np.concatenate([h[i] for h in held]) for i in range(5)], local)


def _later_windows(marked: DataFrame, window: int, buckets: int) -> DataFrame:
    """(id, later): ranges of first words of windows with an equal one in an earlier document, or earlier in the same one, by checksum of the text."""
    rounds, unit = rounds_for(window)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raws in _groups(batches, "text"):
            found = scan(raws)
            names, starts = parse(found.hashes, found.offsets, rounds)
            units, begins, best = anchors(names, starts, found.offsets, window, rounds, unit)
            flagged = np.zeros(int(found.offsets[-1]) + 1, bool)
            places = rows.column("places")
            lengths = places.value_lengths().to_numpy(zero_copy_only=False)
            flat = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            flagged[np.minimum(flat + np.repeat(found.offsets[:-1], lengths), len(flagged) - 1)] = True
            if not len(begins):
                continue
            live = flagged[starts[best]]
            begins, anchor = begins[live], units[best[live]]
            if not len(begins):
                continue
            one, two = window_hashes(found.hashes, begins, window)
            row = np.searchsorted(found.offsets, begins, side="right") - 1
            doc = rows.column("id").to_numpy(zero_copy_only=False)[row]
            mark = np.array([zlib.crc32(r) for r in raws], np.uint32)[row]
            columns = (one, two, doc, mark, (begins - found.offsets[row]).astype(np.int32))
            order, lead, later = _firsts(*columns)
            own, gone = np.sort(order[lead]), np.sort(order[later])
            yield _deal(buckets, anchor[own], tuple(c[own] for c in columns), tuple(c[gone] for c in columns))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *columns, local in _by_bucket(batches):
            rest = [c[~local] for c in columns]
            order, _, later = _firsts(*rest)
            doc, mark, place = (np.concatenate([c[local], r[order[later]]]) for c, r in zip(columns[2:], rest[2:], strict=True))
            order = np.lexsort((place, mark, doc))
            doc, mark, place = doc[order], mark[order], place[order]
            new = np.ones(len(doc) + 1, bool)  # a range ends where the next window does not follow
            new[1:-1] = (np.diff(doc) != 0) | (np.diff(mark) != 0) | (np.diff(place) > 1)
            heads, tails = np.flatnonzero(new[:-1]), np.flatnonzero(new[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[heads]), pa.array(mark[heads].astype(np.int64)), pa.array(place[heads]), pa.array(place[tails])], names=["id", "mark", "first", "last"],
            )

    dealt = marked.select("id", "text", "places").mapInArrow(emit, _DEALT)
    found = _bucketed(dealt).mapInArrow(settle, "id long, mark long, first int, last int")
    return found.groupBy("id").agg(F.collect_list(F.struct("mark", "first", "last")).alias("later"))


def _firsts(one, two, doc, mark, place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by window, document and place; in it, one row for each window, and rows later than the window's first."""
    order = np.lexsort((mark, place, doc, two, one))
    a, b, d, p = one[order], two[order], doc[order], place[order]
    head = np.ones(len(order), bool)
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = (d != d[lead]) | (p != p[lead])
    # Rows that share id and place with the first are as early as it, so they are neither later nor settled.
    return order, ~later, later


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, out: str = "kept_text") -> DataFrame:
    """Per row: key, n_words, n_removed and the kept words joined by one blank.

    A word goes if a window of ``window`` words covers it whose words also start
    in a document with a smaller key, or earlier in the same one; all windows are
    judged on the input. A null text has no words, a text with fewer words than
    a window keeps them all. A null key comes before all others. Rows with equal
    keys do not precede each other at equal places. Keys must be whole numbers.
    """
    source = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(size // 6 // WORDS_PER_BUCKET) + 1
    marked = source.join(_shared_anchors(source, window, buckets), "id")
    # One plan, and both joins on the id alone, so that the texts are shuffled once for both.
    joined = source.join(_later_windows(marked, window, buckets), "id", "left")
    kind = docs.schema[key].dataType
    joined = joined.select(F.nullif(F.col("id"), F.lit(NO_ID)).cast(kind).alias("key"), "text", "later")
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField(out, T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raws in _groups([batch], "text"):
                total, removed, kept = [], [], []
                for raw, later in zip(raws, rows.column("later"), strict=True):
                    words = raw.split()
                    total.append(len(words))
                    if later.is_valid:
                        mark, first, last = (c.to_numpy().astype(np.int64) for c in later.values.flatten())
                        own = mark == zlib.crc32(raw)
                        change = np.zeros(len(words) + window + 1, np.int64)
                        np.add.at(change, first[own], 1)
                        np.add.at(change, last[own] + window, -1)
                        change = change[: len(words) + 1]
                        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                    removed.append(total[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names,
                )

    return joined.mapInArrow(run, schema)
