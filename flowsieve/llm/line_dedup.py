"""Reversible line deduplication: exact reference counts behind sharded cuckoo filters.

Three tables are kept: postings (line digest, document), counts (digest, number
of documents, largest document), and per shard the cuckoo filters of the
digests that enough documents hold. Inserting or deleting documents changes
counts by the difference only, and the filters by the digests that cross the
bound; a filter needs no rebuild for a deletion.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.llm.common import fresh, save

MIN_CHARS, MIN_DOCS, SHARDS = 40, 5, 64
#: Filters are broadcast up to this size (some 50 million digests); beyond it the exact join alone decides.
FILTER_BYTES = 128 << 20
SLOTS, KICKS = 4, 200


def line_key(line: str) -> str:
    """The line without blanks at both ends, A to Z lower-cased."""
    return line.encode().strip().lower().decode()


def digest(key: str) -> bytes:
    return hashlib.md5(key.encode(), usedforsecurity=False).digest()


def line_digest(line: str, min_chars: int) -> bytes | None:
    """Digest of a line's key, none for a key that is too short."""
    if len(line) < min_chars:
        return None
    raw = line.encode().strip().lower()
    if len(raw) < min_chars or len(raw.decode()) < min_chars:
        return None
    return hashlib.md5(raw, usedforsecurity=False).digest()


def postings(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(digest, doc), each pair once per row of the input. Null texts have one empty line, which has no digest."""
    narrow = docs.select(F.col(f"`{key}`").alias("a"), F.col(f"`{text}`").alias("b"))
    schema = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("doc", docs.schema[key].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, row in enumerate(batch.column("b")):
                own = {line_digest(line, min_chars) for line in (row.as_py() or "").split("\n")} - {None}
                found.extend(own)
                owner.extend([i] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column("a").take(pa.array(owner, pa.int64()))], names=["digest", "doc"])

    return narrow.mapInArrow(run, schema)


class Cuckoo:
    """Cuckoo filter of 16-bit fingerprints, four to a bucket; a full table is followed by a further one."""

    def __init__(self, tables: list[np.ndarray] | None = None, expected: int = 1024):
        self.tables = tables if tables is not None else []
        self.expected = expected

    @staticmethod
    def places(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint, first and second bucket of digests given as rows of two 64-bit numbers."""
        mark = (digests[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        first = digests[:, 0] & np.uint64(buckets - 1)
        return mark, first, first ^ Cuckoo.turn(mark, buckets)

    @staticmethod
    def turn(mark: np.ndarray, buckets: int) -> np.ndarray:
        return (mark.astype(np.uint64) * np.uint64(0x5BD1E995) >> np.uint64(4)) & np.uint64(buckets - 1)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        found = np.zeros(len(digests), bool)
        for table in self.tables:
            mark, first, second = self.places(digests, len(table))
            found |= (table[first] == mark[:, None]).any(1) | (table[second] == mark[:, None]).any(1)
        return found

    def insert(self, digests: np.ndarray) -> None:
        """Add digests that are not in yet."""
        for row in digests:
            if not self.tables or not self._put(self.tables[-1], row[None]):
                buckets = 1 << max(4, int(max(self.expected, 2 * sum(t.shape[0] for t in self.tables) * SLOTS) / SLOTS / 0.8).bit_length())
                self.tables.append(np.zeros((buckets, SLOTS), np.uint16))
                self._put(self.tables[-1], row[None])

    def _put(self, table: np.ndarray, row: np.ndarray) -> bool:
        """Place one digest, moving others; if no place is found the table is as before."""
        mark, first, second = (x[0] for x in self.places(row, len(table)))
        undo: list[tuple] = []
        for at in (first, second):
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = mark
                return True
        at = second
        for kick in range(KICKS):
            slot = kick % SLOTS
            undo.append((at, slot, table[at, slot]))
            table[at, slot], mark = mark, table[at, slot]
            at = at ^ self.turn(np.array([mark]), len(table))[0]
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = mark
                return True
        for at, slot, old in reversed(undo):
            table[at, slot] = old
        return False

    def delete(self, digests: np.ndarray) -> None:
        """Remove digests that were inserted."""
        for row in digests:
            for table in reversed(self.tables):
                mark, first, second = (x[0] for x in self.places(row[None], len(table)))
                at, slot = next(((b, s[0]) for b in (first, second) if len(s := np.flatnonzero(table[b] == mark))), (None, None))
                if at is not None:
                    table[at, slot] = 0
                    break

    def dump(self) -> list[bytes]:
        return [t.tobytes() for t in self.tables]

    @classmethod
    def load(cls, tables: list[bytes]) -> Cuckoo:
        return cls([np.frombuffer(t, np.uint16).reshape(-1, SLOTS).copy() for t in tables])


def as_numbers(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def shard_of(column: Column, shards: int) -> Column:
    """Shard of a digest by its last two bytes."""
    return (F.conv(F.hex(F.substring(column, 15, 2)), 16, 10).cast("int") % shards).cast("int")


@dataclass(frozen=True)
class LineIndex:
    """State of the deduplication; every change gives a new state and leaves the old one as it was."""

    postings: DataFrame | None = None
    counts: DataFrame | None = None
    filters: DataFrame | None = None
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS
    shards: int = SHARDS

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> LineIndex:
        """Add documents. A document (a key) that is in already adds only the lines it did not hold. A null key is a document too."""
        new = postings(docs, key, text, self.min_chars).groupBy("digest", "doc").agg(F.lit(1).alias("n"))
        if self.postings is None:
            new = save(new.select("digest", "doc"), "line-postings")
            return self._with(new, new.groupBy("digest").agg(F.count("*").alias("docs"), F.max("doc").alias("largest")))
        new = save(_minus(new, self.postings).select("digest", "doc"), "line-postings")
        change = new.groupBy("digest").agg(F.count("*").alias("docs"), F.max("doc").alias("largest"))
        merged = self.counts.unionByName(change).groupBy("digest").agg(F.sum("docs").alias("docs"), F.max("largest").alias("largest"))
        return self._with(self.postings.unionByName(new), merged)

    def delete(self, keys: DataFrame, key: str = "doc_id") -> LineIndex:
        """Take documents out again; the state is then as if they had never been inserted."""
        gone = keys.select(F.col(f"`{key}`").alias("doc")).distinct().withColumn("n", F.lit(1))
        left = save(_join(self.postings, gone, "left_anti", ["doc"]), "line-postings")
        lost = _join(self.postings, gone, "left_semi", ["doc"]).select("digest").distinct()
        # Only digests that lost a document are counted again.
        again = left.join(lost, "digest", "left_semi").groupBy("digest").agg(F.count("*").alias("docs"), F.max("doc").alias("largest"))
        return self._with(left, self.counts.join(lost, "digest", "left_anti").unionByName(again))

    def _with(self, rows: DataFrame, counts: DataFrame) -> LineIndex:
        counts = save(counts, "line-counts")
        return LineIndex(rows, counts, self._filters(counts), self.min_chars, self.min_docs, self.shards)

    def hot(self) -> DataFrame:
        return self.counts.filter(F.col("docs") >= self.min_docs)

    def _filters(self, counts: DataFrame) -> DataFrame:
        """Filters after the change: digests that now reach the bound go in, those that no longer do come out."""
        reach = counts.filter(F.col("docs") >= self.min_docs).select("digest")
        shard = shard_of(F.col("digest"), self.shards)
        if self.filters is None:
            change = reach.select("digest", F.lit(True).alias("in"))
        else:
            before = self.hot().select("digest")
            change = reach.join(before, "digest", "left_anti").withColumn("in", F.lit(True))
            change = change.unionByName(before.join(reach, "digest", "left_anti").withColumn("in", F.lit(False)))
        change = change.withColumn("shard", shard)

        def update(key: tuple, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            own = Cuckoo.load(list(old["tables"].iloc[0])) if len(old) else Cuckoo(expected=len(rows))
            own.delete(as_numbers(rows.loc[~rows["in"], "digest"].tolist()))
            own.insert(as_numbers(rows.loc[rows["in"], "digest"].tolist()))
            return pd.DataFrame({"shard": [key[0]], "tables": [own.dump()]})

        old = self.filters if self.filters is not None else change.sparkSession.createDataFrame([], "shard int, tables array<binary>")
        merged = old.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(update, "shard int, tables array<binary>")
        return save(merged, "line-filters")

    def drops(self) -> DataFrame:
        """(digest, doc) of all lines to drop: held by enough documents, and not in the largest of them.

        Postings that no filter holds are left out on the map side; the counts decide the rest.
        """
        rows = self.postings
        size = self.filters.agg(F.sum(F.aggregate("tables", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t)))).first()[0]
        if size is None:
            return rows.limit(0)
        if size <= FILTER_BYTES:
            context, shards = rows.sparkSession.sparkContext, self.shards
            shipped = context.broadcast({r["shard"]: [bytes(t) for t in r["tables"]] for r in self.filters.collect()})

            def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                filters = {k: Cuckoo.load(v) for k, v in shipped.value.items()}
                for batch in batches:
                    numbers = as_numbers(batch.column("digest").to_pylist())
                    last = numbers[:, 1] >> np.uint64(48)  # last two bytes, the final one on top
                    own = ((last >> np.uint64(8)) | ((last & np.uint64(255)) << np.uint64(8))).astype(np.int64) % shards
                    keep = np.zeros(len(numbers), bool)
                    for shard in np.unique(own):
                        if int(shard) in filters:
                            at = np.flatnonzero(own == shard)
                            keep[at] = filters[int(shard)].contains(numbers[at])
                    yield batch.filter(pa.array(keep))

            rows = rows.mapInArrow(probe, rows.schema)
        hot = save(self.hot(), "line-hot")
        return rows.join(hot, "digest").filter(~F.col("doc").eqNullSafe(F.col("largest"))).select("digest", "doc")


def _join(rows: DataFrame, other: DataFrame, how: str, keys: list[str]) -> DataFrame:
    on = F.lit(True)
    for k in keys:
        on = on & rows[k].eqNullSafe(other[k])
    return rows.join(other, on, how)


def _minus(new: DataFrame, old: DataFrame) -> DataFrame:
    return _join(new, old, "left_anti", ["digest", "doc"])


def apply_drops(docs: DataFrame, drops: DataFrame, key: str, text: str, names: tuple[str, str, str], min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents with the kept text and the numbers of lines before and dropped, under the given names.

    The text column and columns of these names go; others stay. Null and empty
    texts have one empty line. A document that loses all its lines has an empty text.
    """
    kept_name, before_name, dropped_name = names
    lists, who = fresh(docs, "digests", "who")
    lost = drops.groupBy(F.col("doc").alias(who)).agg(F.collect_list("digest").alias(lists))
    # The list grows with the documents, so the texts meet it by a shuffle at every size.
    lost = save(lost, "line-drops").hint("shuffle_merge")
    joined = docs.join(lost, docs[key].eqNullSafe(lost[who]), "left").drop(who)
    keep = [c for c in docs.columns if c != text and c not in names]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(kept_name, T.StringType()), T.StructField(before_name, T.LongType()), T.StructField(dropped_name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, before, dropped = [], [], []
            for body, gone in zip(batch.column(text), batch.column(lists), strict=True):
                whole = body.as_py() or ""
                gone = set(gone.as_py() or ())
                n = whole.count("\n") + 1
                lines = [line for line in whole.split("\n") if line_digest(line, min_chars) not in gone] if gone else None
                kept.append(whole if lines is None else "\n".join(lines))
                before.append(n)
                dropped.append(0 if lines is None else n - len(lines))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(kept, pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())], names=schema.names,
            )

    return joined.select(*[f"`{c}`" for c in keep], f"`{text}`" if text not in keep else text, lists).mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", names: tuple[str, str, str] = ("kept_text", "n_lines", "n_dropped"), min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Lines held by ``min_docs`` or more documents stay only in the largest of them; short lines always stay."""
    index = LineIndex(min_chars=min_chars, min_docs=min_docs).insert(docs, key, text)
    return apply_drops(docs, index.drops(), key, text, names, min_chars)


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated lines taken out, in the columns they came with. A null text becomes empty."""
    kept, before, dropped = fresh(docs, "kept", "before", "dropped")
    out = dedup_lines(docs, key, text, (kept, before, dropped))
    return out.select(*[F.col(kept).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
