"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) P(word | class). The class comes from a
softmax over hashed features: the last word, the last two together, and the one
before the last (a skip). Words beyond the most frequent stand in these by last byte;
all three features that hold one are there by its own hash too, in rows apart. Its weights are trained by distributed gradient
updates: each task takes minibatch steps from the weights of the round, and the
mean of the steps is the next round's start. Within a class a word has its share
of the training counts, the maximum-entropy solution for word features alone;
classes of rare words keep the Good-Turing share of words met once for unseen
words. Words are compared by 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.llm.common import frequent, save, slices
from flowsieve.llm.words import Words, mix, scan

#: Fixed split: documents whose crc32(id) leaves this remainder are held out.
FOLDS, HELD_OUT = 7, 2
END = np.uint64(0x5ED05ED05ED05ED1)
#: Classes: the end, single frequent words, frequent words by count and last byte, all others by last byte.
SINGLES, LEVELS, LETTERS, RARE = 11, 2, 4, 12
CLASSES = 1 + SINGLES + LEVELS * LETTERS + RARE
FIRST_GROUP, FIRST_RARE = 1 + SINGLES, 1 + SINGLES + LEVELS * LETTERS
#: Words with a class or feature of their own, words whose counts are broadcast for scoring, hashed feature rows.
HEAD, LOOKUP, ROWS = 1 << 16, 1 << 19, 1 << 14
#: Further rows, for the features that words beyond the head have by their own hash: alone, and in pairs.
OWN, PAIRS = 1 << 14, 1 << 14
#: What those rows count as moved before the first step: most are met a few times only, pairs the fewest.
CAUTION, PAIR_CAUTION = 0.25, 1.0
FEATURES, OTHERS = 3, 2
ROUNDS, STEP, BATCH = 2, 0.15, 4096
#: Rows of weights that travel together, and steps summed in one task; both bound what a task holds or reads.
BLOCK, FAN_IN = 1024, 64
BYTES_AT_ONCE = 4 << 20
MOST_DISTINCT = 1 << 21


class Tokens(NamedTuple):
    """Tokens of a group of texts, each text closed by the end token."""

    hashes: np.ndarray
    last: np.ndarray
    offsets: np.ndarray


def tokens(texts: list[bytes]) -> Tokens:
    found: Words = scan([t.lower() for t in texts])
    n = len(texts)
    ends = found.offsets[1:]
    at = ends + np.arange(n)
    own = np.ones(len(found.hashes) + n, bool)
    own[at] = False
    hashes = np.full(len(own), END, np.uint64)
    hashes[own] = found.hashes
    last = np.zeros(len(own), np.uint8)
    last[own] = found.last
    return Tokens(hashes, last, found.offsets + np.arange(n + 1))


def _groups(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for rows in slices(batches, text, BYTES_AT_ONCE):
        yield rows, [(row.as_py() or "").encode() for row in rows.column(text)]


def count_words(docs: DataFrame) -> DataFrame:
    """(h, last, n): training count of each token. Tasks add up their own before the shuffle, in bounded memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, last, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(last.astype(np.int32)), pa.array(counts)], names=["h", "last", "n"])

        for _, raws in _groups(batches):
            got = tokens(raws)
            own, first, n = np.unique(got.hashes, return_index=True, return_counts=True)
            both = np.concatenate([keys, own])
            merged, at, back = np.unique(both, return_index=True, return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(merged)).astype(np.int64)
            last = np.concatenate([last, got.last[first]])[at]
            keys = merged
            if len(keys) > MOST_DISTINCT:
                yield rows()
                keys, last, counts = keys[:0], last[:0], counts[:0]
        yield rows()

    found = docs.select("text").mapInArrow(run, "h long, last int, n long")
    return save(found.groupBy("h").agg(F.max("last").alias("last"), F.sum("n").alias("n")), "word-counts")


class Table(NamedTuple):
    """Frequent words in order of hash: class, feature id and log10 share of the class."""

    keys: np.ndarray
    classes: np.ndarray
    ids: np.ndarray
    share: np.ndarray
    counts: np.ndarray


def head_table(rows: pa.Table) -> Table:
    """Classes of the frequent words. More words than single classes are split by count at half of their sum."""
    keys = rows["h"].to_numpy().view(np.uint64)
    counts, last = rows["n"].to_numpy(), rows["last"].to_numpy()
    order = np.lexsort((keys, -counts))
    keys, counts, last = keys[order], counts[order], last[order]
    word = keys != END
    rank = np.cumsum(word) - 1
    grouped = word & (rank >= SINGLES)
    running = np.cumsum(np.where(grouped, counts, 0))
    level = (running > running[-1] / 2).astype(np.int64) if len(running) else running
    classes = np.where(grouped, FIRST_GROUP + level * LETTERS + last % LETTERS, np.where(word, 1 + rank, 0))
    total = np.bincount(classes, counts, CLASSES)
    share = np.log10(counts / total[classes])
    by_key = np.argsort(keys)
    return Table(*(c[by_key] for c in (keys, classes.astype(np.int16), np.arange(len(keys)) + RARE, share, counts)))


def place(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index of each hash in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, at, -1)


def classify(got: Tokens, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in the table, class, and feature rows of all tokens.

    One column for each feature, and one each for the last word and the one before it by its own
    hash: -1 if it is in the table.
    """
    at = place(table.keys, got.hashes)
    bucket = got.last.astype(np.int64) % RARE
    end = got.hashes == END
    classes = np.where(at >= 0, table.classes[at] if len(table.keys) else 0, np.where(end, 0, FIRST_RARE + bucket))
    ids = np.where(at >= 0, table.ids[at] if len(table.keys) else 0, bucket).astype(np.uint64)
    begin = np.zeros(len(ids), bool)
    begin[got.offsets[:-1]] = True
    start = np.uint64(1 << 40)  # stands before a text
    before = lambda values, first: np.where(begin, first, np.concatenate([[first], values[:-1]]))
    one = before(ids, start)
    two = before(one, start)
    rows = np.full((len(ids), FEATURES + OTHERS), -1, np.int64)
    rows[:, :FEATURES] = np.stack([
        mix(one + np.uint64(1 << 41)), mix(one * np.uint64(0x9E3779B97F4A7C15) + two + np.uint64(1 << 42)), mix(two + np.uint64(3 << 41)),
    ], 1) % np.uint64(ROWS)
    other, own = (at < 0) & ~end, got.hashes
    for k in range(OTHERS):  # the last word, the one before it
        other, own = before(other, False), before(own, start)
        some = np.flatnonzero(other)
        rows[some, FEATURES + k] = ROWS + (mix(own[some] + np.uint64((5 + k) << 41)) % np.uint64(OWN)).astype(np.int64)
    return at, classes, rows


def with_pairs(rows: np.ndarray) -> np.ndarray:
    """The feature rows with one more column: the last two words together, told apart where either is not in the table, else -1.

    Each word stands for this by the row it has alone, its own one if it has one.
    """
    out = np.full((len(rows), rows.shape[1] + 1), -1, np.int32)
    out[:, :-1] = rows
    some = np.flatnonzero((rows[:, FEATURES] >= 0) | (rows[:, FEATURES + 1] >= 0))
    one, two = (np.where(rows[some, own] >= 0, rows[some, own], rows[some, shared]).astype(np.uint64) for own, shared in ((FEATURES, 0), (FEATURES + 1, 2)))
    out[some, -1] = ROWS + OWN + (mix(one * np.uint64(0x9E3779B97F4A7C15) + two + np.uint64(7 << 41)) % np.uint64(PAIRS)).astype(np.int32)
    return out


def log_softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    scores = weights.take(rows[:, 0], 0)
    for k in range(1, FEATURES):
        scores += weights.take(rows[:, k], 0)
    for k in range(FEATURES, rows.shape[1]):
        own = np.flatnonzero(rows[:, k] >= 0)
        scores[own] += weights.take(rows[own, k], 0)
    scores += bias
    scores -= scores.max(1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(1, keepdims=True))
    return scores


def group_sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of the rows from each cut to the next. Neighbours of a group are added in pairs until one is left, all groups at once."""
    sizes, out = np.diff(cuts, append=len(values)), values.take(cuts, 0)
    some = np.flatnonzero(sizes > 1)
    if not len(some):
        return out
    part, sizes = values[np.repeat(sizes > 1, sizes)], sizes[some]
    while True:
        first = np.cumsum(sizes) - sizes
        at = np.arange(len(part)) - np.repeat(first, sizes)
        odd = np.flatnonzero(at & 1)
        part[odd - 1] += part[odd]
        if sizes.max() <= 2:
            out[some] = part.take(first, 0)
            return out
        part, sizes = part.take(np.flatnonzero(at & 1 == 0), 0), (sizes + 1) // 2


def steps(weights: np.ndarray, bias: np.ndarray, batches: Iterator[tuple[np.ndarray, np.ndarray]]) -> int:
    """Minibatch gradient steps in place, sized per feature row by what it has moved so far. Gives the number of tokens."""
    moved, moved_bias, seen = np.full(len(weights), 1e-6, np.float32), np.float32(1e-6), 0
    moved[ROWS:] = CAUTION
    moved[ROWS + OWN :] = PAIR_CAUTION
    for classes, rows in batches:
        for a in range(0, len(classes), BATCH):
            own, at = classes[a : a + BATCH], rows[a : a + BATCH]
            grad = np.exp(log_softmax(weights, bias, at))
            grad[np.arange(len(own)), own] -= 1
            total = grad.sum(0)
            moved_bias += float(total @ total) / CLASSES
            bias -= STEP * total / np.sqrt(moved_bias)
            flat = at.ravel()
            used = np.flatnonzero(flat >= 0)
            flat = flat[used].astype(np.uint16)  # all rows fit, and such numbers sort by radix
            order = flat.argsort(kind="stable")
            flat = flat[order].astype(np.int64)
            cuts = np.flatnonzero(np.diff(flat, prepend=-1))
            sums = group_sums(grad.take(used[order] // at.shape[1], 0), cuts)
            touched = flat[cuts]
            moved[touched] += np.einsum("ij,ij->i", sums, sums) / CLASSES
            sums *= (STEP / np.sqrt(moved[touched]))[:, None]
            weights[touched] -= sums
            seen += len(own)
    return seen


_STEP_SCHEMA = "part long, block int, n double, data binary"


def train(docs: DataFrame, table, stats: dict) -> tuple[np.ndarray, np.ndarray]:
    """Weights after the rounds; each round takes its own share of the training documents, together all of them."""
    weights, bias = np.zeros((ROWS + OWN + PAIRS, CLASSES), np.float32), np.asarray(stats["bias"], np.float32)
    context = docs.sparkSession.sparkContext
    for r in range(ROUNDS):
        shared = context.broadcast((weights, bias))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            before, first = shared.value
            own, own_bias = before.copy(), first.copy()
            part: list[int] = []

            def groups():
                for rows, raws in _groups(batches):
                    part.append(rows.column("part")[0].as_py())
                    _, classes, features = classify(tokens(raws), table.value)
                    yield classes, with_pairs(features)

            seen = steps(own, own_bias, groups())
            if not seen:
                return
            change = np.concatenate([own - before, (own_bias - first)[None]]).astype(np.float32) * seen
            for block, a in enumerate(range(0, len(change), BLOCK)):
                piece = change[a : a + BLOCK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[0]]), pa.array([block], pa.int32()), pa.array([float(seen)]), pa.array([piece.tobytes()], pa.binary())],
                    names=["part", "block", "n", "data"],
                )

        own = docs.filter(F.col("round") == r).select("text", F.spark_partition_id().cast("long").alias("part"))
        change = save(own.mapInArrow(run, _STEP_SCHEMA), "steps")
        while (change.agg(F.max("part")).first()[0] or 0) > 0:
            change = save(_add_up(change.withColumn("part", F.floor(F.col("part") / FAN_IN))), "steps")
        pieces = {row["block"]: row for row in change.collect()}  # one row for each block: the size of the model
        if pieces:
            total = pieces[0]["n"]
            flat = np.concatenate([np.frombuffer(pieces[b]["data"], np.float32) for b in sorted(pieces)]).reshape(-1, CLASSES) / total
            weights, bias = weights + flat[:-1], bias + flat[-1]
    return weights.astype(np.float32), bias.astype(np.float32)


def _add_up(change: DataFrame) -> DataFrame:
    """Sums of at most FAN_IN pieces for each (part, block), one running sum in memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, total = None, 0.0, None
        for batch in batches:
            for part, block, seen, data in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if key != (part, block):
                    if key is not None:
                        yield _piece(key, n, total)
                    key, n, total = (part, block), 0.0, np.zeros(len(data) // 4, np.float32)
                n, total = n + seen, total + np.frombuffer(data, np.float32)
        if key is not None:
            yield _piece(key, n, total)

    dealt = change.repartition("part", "block").sortWithinPartitions("part", "block", "n")
    return dealt.mapInArrow(run, _STEP_SCHEMA)


def _piece(key: tuple, n: float, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int32()), pa.array([n]), pa.array([total.tobytes()], pa.binary())],
        names=["part", "block", "n", "data"],
    )


def score_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score and score (log10, the end counted).

    Null texts count as empty, a null key as an empty one. Repeated rows and
    keys are scored one by one, and counted as often as they occur. Without
    training documents every word is unseen.
    """
    fold = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary"))
    docs = df.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        (fold % FOLDS == HELD_OUT).alias("held_out"), (F.floor(fold / FOLDS) % ROUNDS).cast("int").alias("round"),
    )
    training = docs.filter(~F.col("held_out"))
    counts = count_words(training)
    context = df.sparkSession.sparkContext
    table = head_table(frequent(counts, "n", HEAD).toArrow())
    in_head = F.col("n") >= (int(table.counts.min()) if len(table.counts) else 1 << 62)
    rare = counts.filter(~in_head).groupBy((F.col("last") % RARE).alias("b")).agg(F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("once"))
    rare = {r.b: (r.total, r.once) for r in rare.collect()}
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    sums = np.array([rare.get(b, (0, 0)) for b in range(RARE)], np.float64)
    unseen = (sums[:, 1] + 1) / (sums[:, 0] + 2)
    mass = np.bincount(table.classes, table.counts, CLASSES).astype(np.float64)
    mass[FIRST_RARE:] += sums[:, 0]
    stats = {
        "base": float(np.log10(total + distinct + 1)), "unseen": np.log10(unseen),
        "seen": np.log10(np.maximum(1 - unseen, 1e-300)) - np.log10(np.maximum(sums[:, 0], 1)), "bias": np.log((mass + 1) / (mass + 1).sum()),
    }
    known = frequent(counts, "n", LOOKUP).select("h", "n").toArrow()
    order = np.argsort(known["h"].to_numpy().view(np.uint64))
    shared = context.broadcast(table)
    lookup = context.broadcast((known["h"].to_numpy().view(np.uint64)[order], known["n"].to_numpy()[order]))
    model = context.broadcast(train(training, shared, stats))

    schema = T.StructType([
        T.StructField("key", df.schema[key].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("rest", T.ArrayType(T.LongType())), T.StructField("rest_n", T.ArrayType(T.IntegerType())), T.StructField("rest_b", T.ArrayType(T.IntegerType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (keys, times), (weights, bias) = shared.value, lookup.value, model.value
        for rows, raws in _groups(batches):
            got = tokens(raws)
            at, classes, features = classify(got, own)
            features = with_pairs(features)
            logs = np.concatenate([
                log_softmax(weights, bias, features[a : a + BATCH])[np.arange(len(features[a : a + BATCH])), classes[a : a + BATCH]]
                for a in range(0, len(classes), BATCH)
            ]).astype(np.float64) / np.log(10)
            base, seen = np.zeros(len(at)), at >= 0
            head = np.flatnonzero(seen)
            base[head] = np.log10(own.counts[at[head]] + 1) - stats["base"]
            logs[head] += own.share[at[head]]
            others = np.flatnonzero(~seen)
            where = place(keys, got.hashes[others])
            found, missing = others[where >= 0], others[where < 0]
            n, bucket = times[where[where >= 0]], got.last[found].astype(np.int64) % RARE
            base[found] = np.log10(n + 1) - stats["base"]
            logs[found] += stats["seen"][bucket] + np.log10(n)
            seen[found] = True
            starts = got.offsets[:-1]
            doc = np.searchsorted(got.offsets, missing, side="right") - 1
            pair = np.lexsort((got.hashes[missing], doc))
            doc, rest, b = doc[pair], got.hashes[missing][pair], got.last[missing][pair].astype(np.int32) % RARE
            head_of = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(rest, prepend=np.uint64(0)) != 0))
            times_of = np.diff(np.append(head_of, len(doc))).astype(np.int32)
            cuts = pa.array(np.searchsorted(doc[head_of], np.arange(len(raws) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                rows.column("key"), rows.column("held_out"), pa.array(np.diff(got.offsets)), pa.array(np.add.reduceat(seen.astype(np.int64), starts)),
                pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(logs, starts)),
                pa.ListArray.from_arrays(cuts, pa.array(rest[head_of].view(np.int64))), pa.ListArray.from_arrays(cuts, pa.array(times_of)),
                pa.ListArray.from_arrays(cuts, pa.array(b[head_of])),
            ], names=schema.names)

    scored = docs.select("key", "text", "held_out").mapInArrow(run, schema)
    scored = save(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "rest_n", "rest_b")).alias("r")).select("row", F.col("r.rest").alias("h"), F.col("r.rest_n").alias("t"), F.col("r.rest_b").alias("b"))
    rest = rest.join(counts.select("h", "n"), "h", "left")
    by_bucket = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("b") + 1)
    part = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("t")).otherwise(0)).alias("known2"),
        F.sum(F.col("t") * (F.log10(F.coalesce("n", F.lit(0)) + 1.0) - stats["base"])).alias("base2"),
        F.sum(F.col("t") * F.when(F.col("n").isNull(), by_bucket(stats["unseen"])).otherwise(by_bucket(stats["seen"]) + F.log10(F.col("n").cast("double")))).alias("score2"),
    )
    zero = F.lit(0)
    return scored.join(part, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known2", zero)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("base2", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("score2", zero)).alias("score"),
    )
