"""Token counts by a two-tier lookup on the map side.

A compact table with the lengths of frequent pre-tokens is broadcast; each
worker encodes what the table misses and remembers it. Pre-tokens are never
shuffled: tasks only send a bounded list of their own most frequent ones.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from flowsieve.llm.common import frequent, save

MARK = "▁"
#: Rows of the broadcast table, pre-tokens a task reports, bound of a worker's cache, longest pre-token kept.
TABLE, REPORTED, CACHE, CACHED_CHARS = 32_768, 4_096, 400_000, 48


class Splitter:
    """Cuts texts where no piece of the model can reach across, and counts tokens of the parts.

    That holds for a BPE model with the identity normaliser and byte fallback
    in which the blank mark only starts a piece or fills it. A line feed is cut
    off where no longer piece holds one. Any other model encodes whole texts.
    """

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        pieces = [p.piece for p in proto.pieces if p.type in (p.NORMAL, p.USER_DEFINED)]
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        self.parts = (
            trainer.model_type == trainer.BPE and trainer.byte_fallback and not norm.precompiled_charsmap
            and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not trainer.treat_whitespace_as_suffix
            and not any(MARK in p.lstrip(MARK) for p in pieces)
        )
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.pattern = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if not any("\n" in p for p in pieces) else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        if self.parts:
            norm.add_dummy_prefix = norm.escape_whitespaces = False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return self.pattern.findall(self.prefix + text.replace(" ", MARK)) if self.parts else [text]

    def count(self, part: str) -> int:
        return len(self.model.encode(part))


class Lengths(dict):
    """Tier one at the start, then what the worker has met; a full cache goes back to tier one."""

    def __init__(self, splitter: Splitter, table: dict[str, int]):
        super().__init__(table)
        self.splitter, self.table = splitter, table

    def __missing__(self, part: str) -> int:
        n = self.splitter.count(part)
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHE:
                self.clear()
                self.update(self.table)
            self[part] = n
        return n


_LENGTHS: dict[str, Lengths] = {}


def frequent_parts(df: DataFrame, text: str, model) -> DataFrame:
    """Candidate frequent pre-tokens with their counts: the most frequent ones of each task, over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, counts = Splitter(model.value), Counter()
        for batch in batches:
            for row in batch.column(0):
                counts.update(splitter.split(row.as_py() or ""))
                if len(counts) > CACHE:  # a summary: what is rare so far starts again from nothing
                    counts = Counter(dict(counts.most_common(CACHE // 4)))
        top = [(p, n) for p, n in counts.most_common(REPORTED) if len(p) <= CACHED_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["part", "n"])

    found = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "part string, n long")
    return found.groupBy("part").agg(F.sum("n").alias("n"))


def count_tokens(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """Per row: key, n_bytes, n_tokens and over_limit, as the library counts the whole text.

    Null counts as empty. Repeated rows and null keys stay; other columns do not.
    """
    with open(model_path, "rb") as file:
        raw = file.read()
    context, name = df.sparkSession.sparkContext, hashlib.sha256(raw).hexdigest()
    model, splitter = context.broadcast(raw), Splitter(raw)
    rows = frequent(save(frequent_parts(df, text, model), "frequent-parts"), "n", TABLE).select("part").collect()
    tier = context.broadcast({r.part: splitter.count(r.part) for r in rows})
    narrow = df.select(F.col(f"`{key}`").alias("a"), F.col(f"`{text}`").alias("b"))
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _LENGTHS:
            _LENGTHS.clear()
            _LENGTHS[name] = Lengths(Splitter(model.value), tier.value)
        lengths = _LENGTHS[name]
        split, of = lengths.splitter.split, lengths.__getitem__
        for batch in batches:
            texts = (row.as_py() or "" for row in batch.column("b"))
            sizes = [(len(t.encode()), sum(map(of, split(t)))) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("a"), pa.array([b for b, _ in sizes], pa.int64()), pa.array([n for _, n in sizes], pa.int64()),
                pa.array([n > limit for _, n in sizes], pa.bool_()),
            ], names=schema.names)

    return narrow.mapInArrow(run, schema)
