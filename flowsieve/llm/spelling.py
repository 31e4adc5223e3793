"""Spelling variants: words at one edit, found by scanning a sorted list with a banded edit matrix.

Each word is compared with the words after it in sorted order. The matrix rows
of a prefix hold for all words that share it, so the next word starts at its
common prefix with the last one, and where a row exceeds one edit all words with
that prefix are skipped. Lists are kept short without losing a pair: two words at
one edit share the first half or the last half, so words are listed by either,
and a list that is still long is divided by halves of what is left.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import save, slices

#: Fixed values of the contract: shortest word, fewest occurrences, and how many times a form must be as frequent.
MIN_CHARS, MIN_COUNT, RATIO = 7, 2, 10
#: One run in so many loses a letter.
EVERY = 31
#: Words of a list; longer lists are divided. Distinct words counted in a task before they are sent on.
LIST, HELD = 96, 200_000
#: Cells of the letters compared at once.
CELLS = 1 << 20
#: Runs of a text handled at once.
SLICE = 100_000
LETTERS = "a-zÀ-ÿ"


def runs_of(text: str, least: int = MIN_CHARS) -> Iterator[list[str]]:
    """Maximal runs of letters of at least that length, A to Z in lower case, in slices."""
    found = (m.group() for m in re.finditer(f"[{LETTERS}]{{{least},}}", text.encode().lower().decode()))
    while part := list(islice(found, SLICE)):
        yield part


def _shortened(runs: list[str], start: int) -> dict[str, str]:
    """The runs that lose a letter, with what is left; ``start`` is the checksum of the key and a colon."""
    out = {}
    for run in set(runs):
        h = zlib.crc32(run.encode(), start)
        if not h % EVERY:
            at = h % len(run)
            out[run] = run[:at] + run[at + 1 :]
    return out


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of all texts with their number: (word, n). Null texts have none, a null key is written as nothing.

    Tasks send on sums, so a word of every document does not make a hot key.
    """
    narrow = df.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def sent() -> pa.RecordBatch:
            rows = [(w, n) for w, n in counts.items() if len(w) >= MIN_CHARS]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["word", "n"])

        for batch in slices(batches, "text", 1 << 20):
            for of, row in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                start = zlib.crc32(f"{of or ''}:".encode())
                for runs in runs_of(row.as_py() or ""):
                    changed = _shortened(runs, start)
                    counts.update(map(changed.get, runs, runs) if changed else runs)
            if len(counts) > HELD:
                yield sent()
        yield sent()

    return narrow.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def near_pairs(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b), a < b, of one list whose strings differ by at most one edit.

    ``codes`` holds a string a row, filled up with zeros; the rows of a list are
    adjacent, sorted and distinct, and ``ends`` is the row after their list.
    A cell (r, k) of the band is the number of edits between r letters of b and r + k - 1 of a.
    """
    n, width = codes.shape
    lcp = np.zeros(n + 1, np.int64)
    if n > 1:
        differ = codes[1:] != codes[:-1]
        lcp[1:n] = np.where(differ.any(1), differ.argmax(1), width)
    starts = np.flatnonzero(np.diff(ends, prepend=-1))
    lcp[starts] = 0
    # Per row and depth the next row whose common prefix with the row before it is shorter.
    after = np.full((n + 1, width + 2), n, np.int32)
    for depth in range(1, width + 2):
        at = np.where(lcp[1:n] < depth, np.arange(1, n), n)
        after[: n - 1, depth] = np.minimum.accumulate(at[::-1])[::-1] if n > 1 else n
    rows = np.ones((n, width + 2, 3), np.uint8)  # of each string against its own prefixes, to begin with
    rows[:, :, 1] = 0
    rows[:, 0, 0] = 9
    own = np.zeros((n, width + 3), codes.dtype)
    own[:, 1 : width + 1] = codes
    me = np.arange(n)
    me = me[me + 1 < ends]
    at = me + 1
    depth = lcp[at]
    left, right = [], []
    while len(me):
        letter, old = codes[at, depth], rows[me, depth]
        low = np.minimum(old[:, 0] + (letter != own[me, depth]), old[:, 1] + 1)
        mid = np.minimum(np.minimum(old[:, 1] + (letter != own[me, depth + 1]), old[:, 2] + 1), low + 1)
        high = np.minimum(old[:, 2] + (letter != own[me, depth + 2]), mid + 1)
        depth = depth + 1
        new = np.stack([low, mid, high], 1).astype(np.uint8)
        rows[me, depth] = new
        alive = new.min(1) <= 1
        whole = depth == sizes[at]
        if (whole & alive).any():
            hit = np.flatnonzero(whole & alive)
            offset = sizes[me[hit]] - sizes[at[hit]] + 1
            hit, offset = hit[np.abs(offset - 1) <= 1], offset[np.abs(offset - 1) <= 1]
            hit = hit[new[hit, offset] <= 1]
            left.append(me[hit])
            right.append(at[hit])
        move = whole | ~alive
        target = np.where(alive, at + 1, after[at, depth])
        at = np.where(move, target, at)
        depth = np.where(move, lcp[at], depth)
        stay = at < ends[me]
        if not stay.all():
            me, at, depth = me[stay], at[stay], depth[stay]
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _start(words: DataFrame) -> DataFrame:
    """Each word in the class of its own length and of one letter less: the shorter length of a pair is its class."""
    size = F.length("word")
    classes = F.explode(F.array(size, size - 1)).alias("size")
    rows = words.select("word", "n", classes).filter(F.col("size") >= MIN_CHARS)
    return rows.select("word", "n", "size", F.lit(0).alias("i"), F.lit(0).alias("j"), (F.col("size") + 2).alias("cap"))


def _halved(rows: DataFrame) -> DataFrame:
    """Rows by the first and by the last half of what is between the first i and the last j letters.

    A pair belongs to the list of the first half if it shares it, else to the
    list of the last half, where only pairs with a common prefix below ``cap`` count: each pair has one list.
    """
    gap = F.col("size") - F.col("i") - F.col("j")
    half = F.floor(gap / 2).cast("int")
    first = F.struct((F.col("i") + half).alias("i"), F.col("j").alias("j"), F.col("cap").alias("cap"))
    last = F.struct(F.col("i").alias("i"), (F.col("j") + gap - half).alias("j"), (F.col("i") + half).alias("cap"))
    return rows.select("word", "n", "size", F.explode(F.array(first, last)).alias("to")).select("word", "n", "size", "to.*")


def _list_key() -> Column:
    return F.xxhash64("size", "i", "j", "cap", F.expr("left(word, i)"), F.expr("right(word, j)"))


def near_words(words: DataFrame, most: int = LIST) -> DataFrame:
    """Per word with near words: (word, n_near, form_n, form), the most frequent near word and the least of equals.

    ``words`` are distinct (word, n). Lists of more than ``most`` words are
    divided until one letter is left open, so a list is bounded by the alphabet.
    """
    todo, ready = _halved(_halved(_start(words))), []
    gap = F.col("size") - F.col("i") - F.col("j")
    while True:
        keyed = todo.withColumn("key", _list_key())
        sizes = save(keyed.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "spelling-lists")
        sized = save(keyed.join(sizes, "key").withColumn("gap", gap), "spelling-rows")
        long = (F.col("m") > most) & (F.col("gap") > 1)
        ready.append(sized.filter(~long))
        rest = sized.filter(long)
        if rest.isEmpty():
            break
        todo = _halved(rest)
    rows = ready[0]
    for more in ready[1:]:
        rows = rows.unionByName(more)
    open_part = F.expr("substring(word, i + 1, length(word) - i - j)").alias("part")
    rows = rows.select("gap", "key", open_part, "word", "n", "i", "j", "cap").repartition("key").sortWithinPartitions("gap", "key", "part")
    found = rows.mapInArrow(_scan_lists, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return out.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def _scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of sorted lists, a bounded number of whole lists at a time."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        key = held.column("key").to_numpy()
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        gap = held.column("gap").to_numpy()
        start = 0
        while len(cuts) and start < cuts[-1]:
            # The longest gap of the rows taken decides how many fit; a list is never cut.
            fit = cuts[cuts > start]
            cells = (fit - start) * (gap[fit - 1] + 2)
            stop = int(fit[max(np.searchsorted(cells, CELLS, side="right") - 1, 0)])
            yield _scan_rows(held.slice(start, stop - start))
            start = stop
        held = held.slice(start)
    if held is not None and held.num_rows:
        yield _scan_rows(held)


def _scan_rows(rows: pa.Table) -> pa.RecordBatch:
    words, n, key = rows.column("word").to_pylist(), rows.column("n").to_numpy(), rows.column("key").to_numpy()
    i, j, cap, gap = (rows.column(c).to_numpy().astype(np.int64) for c in ("i", "j", "cap", "gap"))
    gaps = rows.column("part").to_pylist()
    sizes = np.array([len(g) for g in gaps])
    codes = np.array(gaps, f"<U{max(int(sizes.max()), 1)}").view(np.uint32).reshape(len(gaps), -1)
    bounds = np.append(np.flatnonzero(np.diff(key)) + 1, len(key))
    a, b = near_pairs(codes, sizes, np.repeat(bounds, np.diff(bounds, prepend=0)))
    # The shorter length of a pair is its class, and a common prefix of the cap or more has its own list.
    once = (np.minimum(sizes[a], sizes[b]) == gap[a]) & (i[a] + (codes[a] != codes[b]).argmax(1) < cap[a])
    # Lists go by a hash, so what a list should share is looked at once more.
    same = [words[x][: i[x]] == words[y][: i[x]] and words[x][len(words[x]) - j[x] :] == words[y][len(words[y]) - j[x] :] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    keep = once & np.array(same, bool)
    a, b = a[keep], b[keep]
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(np.array(words))] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], one))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.diff(one, prepend=-1))
    counts = np.diff(np.append(first, len(one)))
    return pa.RecordBatch.from_arrays([
        pa.array([words[x] for x in one[first].tolist()], pa.string()), pa.array(counts, pa.int64()),
        pa.array(n[other[first]], pa.int64()), pa.array([words[y] for y in other[first].tolist()], pa.string()),
    ], names=["word", "n_near", "form_n", "form"])


def roots(forms: DataFrame) -> DataFrame:
    """The last of the chain of forms that starts at each word: (word, root), from (word, form).

    Forms are more frequent than their words, so chains end; each round doubles what is followed.
    """
    now = save(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        onward = now.select(F.col("word").alias("of"), F.col("root").alias("next"))
        joined = now.join(onward, F.col("root") == F.col("of"), "left")
        step = save(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def group_words(words: DataFrame, ratio: int = RATIO, most: int = LIST) -> DataFrame:
    """Per distinct (word, n): word, form, root, n, n_near, form_n.

    The form of a word is its near word (one letter inserted, deleted or
    replaced) with the largest n, the least in code-point order of equals, if that is at least ``ratio`` times as frequent.
    """
    near = save(near_words(words, most), "spelling-near").withColumnRenamed("word", "of")
    joined = words.join(near, F.col("word") == F.col("of"), "left")
    fits = F.col("form_n") >= ratio * F.col("n")
    joined = save(joined.select(
        "word", F.when(fits, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("form_n")).alias("form_n"),
    ), "spelling-words")
    last = roots(joined.filter("form is not null")).withColumnRenamed("word", "of")
    out = joined.join(last, F.col("word") == F.col("of"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spelling variants of all words of the texts, with planted errors by the checksum of key and run.

    Words are runs of at least seven letters that occur twice or more. Texts are
    taken whole; null and empty texts, and tables without rows, give no words. Repeated rows count again.
    """
    words = count_words(df, key, text).filter(F.col("n") >= MIN_COUNT)
    return group_words(save(words, "spelling-vocabulary"))
