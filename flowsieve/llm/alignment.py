"""Alignment of two tokenizers by Arrow tables: groups, links and corpus-wide counts of linked ids.

Tokens of both sides are lists; flattened, with parent indices and segmented
cumulative sums, each token has the key of its text and its end in bytes. A hash
join on that key pairs the ends: a text's links are its distinct ends, and the
ends that both sides have cut it into groups. Partial counts of id pairs are
grouped in Arrow and added up by Spark.

Texts are joined up from units (blanks and what follows them) that neither
tokenizer reaches over, so a unit is aligned once and remembered by the worker.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from flowsieve.llm.common import fresh, save, slices

MARK = "▁"
#: Bytes of text whose links are counted together, and bytes of text cut into units at once.
CHUNK, SLICE = 8 << 20, 1 << 20
#: Characters of the units a worker remembers, and units aligned at once.
CACHE_CHARS, UNITS = 1_500_000, 20_000
#: Separators that are blanks to Python only.
SEPARATORS = "\x1c\x1d\x1e\x1f"
EMPTY_DIGEST = ""


def byte_table() -> dict[str, int]:
    """The characters by which byte-level vocabularies write the 256 bytes: printable ones themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Sides:
    """Both tokenizers of a worker, and the bytes of their entries."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        bytes_of = byte_table()
        names = {at: name for name, at in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = pa.array([bytes(bytes_of.get(c, 63) for c in names.get(at, "")) for at in range(max(names) + 1)], pa.binary())
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(pieces)
        normal = [p.piece for p in proto.pieces if p.type in (p.NORMAL, p.USER_DEFINED)]
        norm = proto.normalizer_spec
        # A unit ends before a blank that follows another character, unless some piece holds them in that order.
        inner = {blank for p in normal for blank in re.findall(f"(?<=[^\\s{MARK}])[\\s{MARK}]", p)}
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces or MARK in inner:
            raise ValueError("the piece model must add a blank, leave texts as they are, and hold blanks at the start of pieces only")
        self.unit = re.compile(f"\\s*\\S+(?:[{re.escape(SEPARATORS + ''.join(sorted(inner)))}]\\s*\\S*)*|\\s+")
        norm.add_dummy_prefix = False
        self.b = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.bytes_b = pa.array(
            [bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else p.piece.replace(MARK, " ").encode() for p in proto.pieces], pa.binary(),
        )

    def encode(self, units: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        return pa.array(a, pa.list_(pa.int64())), pa.array(self.b.encode(units, num_threads=1), pa.list_(pa.int64()))


def ends_of(tokens: pa.ListArray, entries: pa.Array) -> pa.Table:
    """Per token of the lists: key (number of its text, then its end in bytes), id. In order."""
    ids, of = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
    sums = pc.cumulative_sum(pc.cast(pc.binary_length(pc.take(entries, ids)), pa.int64()))
    starts = tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
    before = np.concatenate([[0], sums.to_numpy()])[starts[:-1]]
    end = pc.subtract(sums, pc.take(pa.array(before), of))
    return pa.table({"key": pc.add(pc.shift_left(pc.cast(of, pa.int64()), 32), end), "id": ids})


def joined_bytes(tokens: pa.ListArray, entries: pa.Array) -> pa.Array:
    whole = pa.ListArray.from_arrays(tokens.offsets, pc.take(entries, pc.list_flatten(tokens)))
    return pc.binary_join(whole, b"")


class Aligned:
    """Results of a set of texts, a row each."""

    def __init__(self, texts: list[str], sides: Sides):
        a, b = sides.encode(texts)
        raw = pa.array([t.encode() for t in texts], pa.binary())
        self.whole = pc.and_(pc.equal(joined_bytes(a, sides.bytes_a), raw), pc.equal(joined_bytes(b, sides.bytes_b), raw)).to_numpy(zero_copy_only=False)
        self.n_a, self.n_b = pc.list_value_length(a).to_numpy().astype(np.int64), pc.list_value_length(b).to_numpy().astype(np.int64)
        left, right = ends_of(a, sides.bytes_a).rename_columns(["key", "a"]), ends_of(b, sides.bytes_b).rename_columns(["key", "b"])
        ends = left.join(right, "key", join_type="full outer", use_threads=False).sort_by("key")
        both = pc.and_(pc.is_valid(ends["a"]), pc.is_valid(ends["b"]))
        of = pc.shift_right(ends["key"], 32).to_numpy()
        count = lambda rows: np.bincount(rows, minlength=len(texts)).astype(np.int64)
        self.n_links, self.n_groups = count(of), count(of[both.to_numpy()])
        # An end belongs to the token that ends there or next, so gaps are filled from behind. The last ends of a text
        # are equal; where they are not (its bytes differ), its links are not used.
        pair = pc.add(pc.shift_left(pc.fill_null_backward(ends["a"]).fill_null(0), 32), pc.fill_null_backward(ends["b"]).fill_null(0))
        self.pairs, self.starts = pair.to_numpy(), np.concatenate([[0], np.cumsum(self.n_links)])
        fine = lambda table: table.filter(pa.array(self.whole[pc.shift_right(table["key"], 32).to_numpy()]))
        self.groups = self._groups(fine(left), fine(right), fine(ends.filter(both))["key"], len(texts))

    def _groups(self, left: pa.Table, right: pa.Table, common: pa.ChunkedArray, n: int) -> list[str]:
        """Per text its groups, ids joined by commas, sides by a bar, groups by semicolons. Every token must be in one."""
        cuts = common.to_numpy()
        sides = []
        for table, name in ((left, "a"), (right, "b")):
            at = np.searchsorted(table["key"].to_numpy(), cuts, side="right")
            offsets = pa.array(np.concatenate([[0], at]).astype(np.int32))
            sides.append(pc.binary_join(pa.ListArray.from_arrays(offsets, pc.cast(table[name].combine_chunks(), pa.string())), ","))
        groups = pc.binary_join_element_wise(*sides, "|")
        offsets = np.searchsorted(cuts, np.arange(n + 1, dtype=np.int64) << 32).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), groups), ";").to_pylist()


class Memory(dict):
    """Units a worker has met: unit to row number; results are in arrays by that number."""

    FIELDS = ("whole", "n_a", "n_b", "n_groups", "n_links")

    def __init__(self, sides: Sides):
        super().__init__()
        self.sides = sides
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.groups: list[str] = []
        self.held = 0
        self.columns = {name: np.zeros(0, bool if name == "whole" else np.int64) for name in self.FIELDS}
        self.pairs = np.zeros(0, np.int64)

    def __missing__(self, unit: str) -> int:
        self[unit] = at = len(self)
        self.new.append(unit)
        self.held += len(unit)
        return at

    def align_new(self) -> None:
        parts: list[Aligned] = []
        for at in range(0, len(self.new), UNITS):
            parts.append(Aligned(self.new[at : at + UNITS], self.sides))
            self.groups.extend(parts[-1].groups)
        if parts:
            for name in self.FIELDS:
                self.columns[name] = np.concatenate([self.columns[name], *(getattr(p, name) for p in parts)])
            self.pairs = np.concatenate([self.pairs, *(p.pairs for p in parts)])
            self.starts = np.concatenate([[0], np.cumsum(self.columns["n_links"])])
        self.new = []


def _links(memory: Memory, of: np.ndarray, codes: np.ndarray) -> pa.Table:
    """(doc, pair, times) of units ``codes`` in documents ``of``: how often each document links each pair of ids."""
    units = pa.table({"doc": of, "unit": codes}).group_by(["doc", "unit"], use_threads=False).aggregate([([], "count_all")])
    code, doc, times = units["unit"].to_numpy(), units["doc"].to_numpy(), units["count_all"].to_numpy()
    sizes = memory.columns["n_links"][code]
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(memory.starts[code] - (ends - sizes), sizes) if len(code) else np.zeros(0, np.int64)
    found = pa.table({"doc": np.repeat(doc, sizes), "pair": memory.pairs[place], "times": np.repeat(times, sizes)})
    found = found.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    return pa.table({"doc": found["doc"], "pair": found["pair"], "times": found["times_sum"]})


#: A row is a document (its numbers, and per linked pair its place in the chunk's list and its times) or a chunk (the list).
_ROWS = [
    T.StructField("chunk", T.StringType()), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()), T.StructField("n_links", T.LongType()), T.StructField("groups_sha256", T.StringType()),
    T.StructField("place", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.IntegerType())),
    T.StructField("pair", T.ArrayType(T.LongType())), T.StructField("docs", T.ArrayType(T.LongType())),
]


class _Chunk:
    """Documents of a worker until their links are counted together."""

    def __init__(self) -> None:
        self.keys: list[pa.Array] = []
        self.numbers: list[np.ndarray] = []
        self.digests: list[str] = []
        self.links: list[pa.Table] = []
        self.size = self.rows = 0

    def add(self, keys: pa.Array, texts: pa.Array, memory: Memory) -> None:
        if memory.held > CACHE_CHARS:
            memory.forget()
        units = [memory.sides.unit.findall(" " + t) if t else [] for t in texts.to_pylist()]
        counts = np.array([len(u) for u in units])
        codes = np.fromiter((memory[u] for row in units for u in row), np.int64, int(counts.sum()))
        memory.align_new()
        of = np.repeat(np.arange(len(units)), counts)
        whole = (counts > 0) & (np.bincount(of[~memory.columns["whole"][codes]], minlength=len(units)) == 0)
        of, codes = of[whole[of]], codes[whole[of]]
        total = lambda name: np.bincount(of, memory.columns[name][codes], len(units)).astype(np.int64)
        self.numbers.append(np.stack([total(name) for name in ("n_a", "n_b", "n_groups", "n_links")], 1))
        groups, at = memory.groups, 0
        for fine, count in zip(whole.tolist(), np.where(whole, counts, 0).tolist(), strict=True):
            joined = ";".join([groups[c] for c in codes[at : at + count].tolist()]) if fine else ""
            self.digests.append(hashlib.sha256(joined.encode()).hexdigest() if fine else EMPTY_DIGEST)
            at += count
        self.links.append(_links(memory, of + self.rows, codes))
        self.keys.append(keys)
        self.size += int(pc.sum(pc.binary_length(texts)).as_py() or 0)
        self.rows += len(units)

    def batches(self, name: str, key: str) -> Iterator[pa.RecordBatch]:
        links = pa.concat_tables(self.links)
        found = links.group_by("pair", use_threads=False).aggregate([("doc", "count")])
        links = links.take(pc.sort_indices(links["doc"]))
        place = pc.index_in(links["pair"].combine_chunks(), value_set=found["pair"].combine_chunks())
        offsets = pa.array(np.searchsorted(links["doc"].to_numpy(), np.arange(self.rows + 1)).astype(np.int32))
        numbers, keys = np.concatenate(self.numbers), pa.concat_arrays(self.keys)
        none = lambda kind, n: pa.nulls(n, kind)
        longs = pa.list_(pa.int64())
        names = [key, *(f.name for f in _ROWS)]
        yield pa.RecordBatch.from_arrays([
            keys, pa.array([name] * self.rows), *(pa.array(numbers[:, k]) for k in range(4)), pa.array(self.digests, pa.string()),
            pa.ListArray.from_arrays(offsets, place), pa.ListArray.from_arrays(offsets, pc.cast(links["times"].combine_chunks(), pa.int32())),
            none(longs, self.rows), none(longs, self.rows),
        ], names=names)
        one = pa.array([0, found.num_rows], pa.int32())
        yield pa.RecordBatch.from_arrays([
            none(keys.type, 1), pa.array([name]), *(none(pa.int64(), 1) for _ in range(4)), none(pa.string(), 1),
            none(pa.list_(pa.int32()), 1), none(pa.list_(pa.int32()), 1),
            pa.ListArray.from_arrays(one, found["pair"].combine_chunks()), pa.ListArray.from_arrays(one, found["doc_count"].combine_chunks()),
        ], names=names)


_MEMORY: dict[str, Memory] = {}


def align_chunks(df: DataFrame, byte_level_path: str, piece_path: str, key: str, text: str) -> DataFrame:
    """Rows of documents and of chunks (``pair`` is not null), see ``_ROWS``; a pair is the first id times 2**32 and the second."""
    with open(byte_level_path) as file:
        byte_level = file.read()
    with open(piece_path, "rb") as file:
        pieces = file.read()
    Sides(byte_level, pieces)  # unfit models are an error here, not in the tasks
    context = df.sparkSession.sparkContext
    models, name = context.broadcast((byte_level, pieces)), hashlib.sha256(byte_level.encode() + pieces).hexdigest()
    a, b = fresh(df.select(f"`{key}`"), "a", "b")
    narrow = df.select(F.col(f"`{key}`").alias(a), F.col(f"`{text}`").alias(b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if name not in _MEMORY:
            _MEMORY.clear()
            _MEMORY[name] = Memory(Sides(*models.value))
        chunk, number = _Chunk(), 0
        for batch in slices(batches, b, SLICE):
            chunk.add(batch.column(a), batch.column(b), _MEMORY[name])
            if chunk.size >= CHUNK:
                yield from chunk.batches(f"{TaskContext.get().partitionId()}-{number}", key)
                chunk, number = _Chunk(), number + 1
        if chunk.rows:
            yield from chunk.batches(f"{TaskContext.get().partitionId()}-{number}", key)
        pa.default_memory_pool().release_unused()

    return narrow.mapInArrow(run, T.StructType([T.StructField(key, df.schema[key].dataType), *_ROWS]))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, top): in how many documents a pair is linked, and whether no other pair of its first id is in more."""
    counts = save(chunks.groupBy("pair").agg(F.sum("docs").alias("n")), "pair-counts")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("first")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("first", first).join(most, "first")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("top"))


def align_tokenizers(df: DataFrame, byte_level_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    The byte-level side encodes a blank and the text, the piece side the text.
    Null and empty texts, and texts whose bytes either side does not give back,
    have zeros and no digest. Rows are documents: repeated rows and null keys stay. Memory follows the longest text.

    Documents are handled in chunks of some megabytes. Each chunk sends a pair
    once, so no pair is a hot key, and gets back the counts of its own pairs.
    """
    rows = save(align_chunks(df, byte_level_path, piece_path, key, text), "aligned")
    listed = rows.filter("pair is not null").select("chunk", F.posexplode(F.arrays_zip("pair", "docs")).alias("at", "x"))
    listed = listed.select("chunk", "at", "x.pair", "x.docs")
    known = listed.select("chunk", "at", "pair").join(save(pair_counts(listed), "pairs"), "pair").select(F.col("chunk").alias("of"), "at", "n", "top")
    docs = rows.filter("pair is null").drop("pair", "docs")
    out = T.StructType([
        T.StructField(key, df.schema[key].dataType), *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
        T.StructField("groups_sha256", T.StringType()),
    ])

    def merge(of_docs: pa.Table, of_pairs: pa.Table) -> pa.Table:
        """Counts of a chunk's pairs looked up by their places, added up per document."""
        size = of_pairs.num_rows
        n, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = of_pairs["at"].to_numpy()
        n[at], top[at] = of_pairs["n"].to_numpy(), of_pairs["top"].to_numpy(zero_copy_only=False)
        place, times = of_docs["place"].combine_chunks(), of_docs["times"].combine_chunks()
        doc, where = pc.list_parent_indices(place).to_numpy(), pc.list_flatten(place).to_numpy()
        many = pc.list_flatten(times).to_numpy().astype(np.int64)

        def total(values: np.ndarray) -> pa.Array:
            sums = np.concatenate([[0], np.cumsum(values)])
            cuts = np.searchsorted(doc, np.arange(of_docs.num_rows + 1))
            return pa.array(sums[cuts[1:]] - sums[cuts[:-1]])

        columns = {c: of_docs[c] for c in (key, "n_a", "n_b", "n_groups", "n_links")}
        return pa.table({**columns, "n_best": total(top[where] * many), "count_sum": total(n[where] * many), "groups_sha256": of_docs["groups_sha256"]})

    return docs.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(merge, out)
