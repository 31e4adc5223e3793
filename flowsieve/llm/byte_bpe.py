"""Byte-level BPE through a sentencepiece model built from the rank table.

Each byte stands for one character, each vocabulary entry is a piece scored by
its negative rank, and normalisation is the identity; sentencepiece then merges
in rank order. Pre-tokens are encoded one by one and kept in a worker cache.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from flowsieve.llm.common import fresh, slices

#: Characters from this code point on stand for the 256 bytes; none of them is a blank or a control.
FIRST = 0x100
TO_CHARS = {b: chr(FIRST + b) for b in range(256)}
#: Bound of a worker's cache, and the longest pre-token kept in it. A full cache starts anew.
CACHE, CACHED_CHARS = 100_000, 48
#: Pre-tokens handled at once, so a very long text needs little memory.
SLICE = 50_000
#: Rows decoded at once.
ROWS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank table of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def build_model(ranks: dict[bytes, int]) -> bytes:
    """Serialised sentencepiece model; piece i is the token of rank i, and the unknown piece follows the last."""
    if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be 0 to n - 1 and hold every single byte")
    model = sentencepiece_model_pb2.ModelProto()
    for token in sorted(ranks, key=ranks.__getitem__):
        model.pieces.add(piece=as_chars(token), score=-float(ranks[token]))
    model.pieces.add(piece="<unk>", score=0.0, type=sentencepiece_model_pb2.ModelProto.SentencePiece.UNKNOWN)
    trainer, norm = model.trainer_spec, model.normalizer_spec
    trainer.model_type = sentencepiece_model_pb2.TrainerSpec.BPE
    trainer.vocab_size, trainer.unk_id = len(ranks) + 1, len(ranks)
    trainer.bos_id = trainer.eos_id = trainer.pad_id = -1
    norm.name, norm.precompiled_charsmap = "identity", b""
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


def as_chars(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_CHARS)


class Codec:
    """Encoder and decoder of one worker, with a bounded cache from pre-token to ids."""

    def __init__(self, model: bytes, pattern: str):
        self.split = regex.compile(pattern)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.pieces.get_piece_size() - 1
        self.tokens = [bytes(ord(c) - FIRST for c in self.pieces.id_to_piece(i)) for i in range(size)]
        self.whole = {t: i for i, t in enumerate(self.tokens)}
        self.digits = [str(i) for i in range(size)]
        self.cache: dict[str, list[int]] = {}

    def pretoken(self, part: str) -> list[int]:
        """Ids of one pre-token: a token as a whole where there is one, else the merges."""
        ids = self.cache.get(part)
        if ids is None:
            raw = part.encode()
            at = self.whole.get(raw)
            ids = [at] if at is not None else self.pieces.encode(as_chars(raw))
            if len(part) <= CACHED_CHARS:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[part] = ids
        return ids

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, in slices."""
        parts = (m.group() for m in self.split.finditer(text)) if len(text) > 1 << 20 else iter(self.split.findall(text))
        known, pretoken = self.cache.get, self.pretoken
        while chunk := list(islice(parts, SLICE)):
            ids: list[int] = []
            for part in chunk:
                ids += known(part) or pretoken(part)
            yield ids

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


_CODECS: dict[tuple, Codec] = {}


def codec(model, pattern: str, name: str) -> Codec:
    """The worker's codec for a broadcast model; only the latest is kept."""
    if (name, pattern) not in _CODECS:
        _CODECS.clear()
        _CODECS[name, pattern] = Codec(model.value, pattern)
    return _CODECS[name, pattern]


def _shipped(df: DataFrame, path: str):
    model = build_model(read_ranks(path))
    return df.sparkSession.sparkContext.broadcast(model), hashlib.sha256(model).hexdigest()


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "ids", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The frame with the token ids of each whole text as an array; null counts as empty. Replaces a column of that name."""
    model, name = _shipped(df, path)
    keep = [c for c in df.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, pattern, name)
        for batch in slices(batches, text, 1 << 20):
            rows = [np.concatenate([np.zeros(0, np.int32), *(np.array(part, np.int32) for part in own.encode(t.as_py() or ""))]) for t in batch.column(text)]
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], found], names=[*keep, ids])
        pa.default_memory_pool().release_unused()  # workers live on between stages

    schema = T.StructType([*[f for f in df.schema.fields if f.name != ids], T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with the bytes of each id array; null counts as empty. Ids outside the vocabulary are an error."""
    model, name = _shipped(df, path)
    keep = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, public_tokenizers.PATTERN, name)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                rows = [own.decode(row.values.to_numpy().tolist()) if row.is_valid else b"" for row in batch.column(ids)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(rows, pa.binary())], names=[*keep, out])
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.BinaryType())]))


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 and decoded_sha256, the digests of the ids and of the bytes they decode to.

    Each text is encoded whole, slice by slice, and each slice decoded from its
    ids, so memory does not follow the length of a text. Null counts as empty;
    repeated rows and null keys stay. No shuffle.
    """
    model, name = _shipped(df, path)
    a, b = fresh(df.select(f"`{key}`"), "a", "b")
    narrow = df.select(F.col(f"`{key}`").alias(a), F.col(f"`{text}`").alias(b))
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, pattern, name)
        digits = own.digits
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for row in batch.column(b):
                total, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
                for ids in own.encode(row.as_py() or ""):
                    of_ids.update(("," if total else "").encode() + ",".join([digits[i] for i in ids]).encode())
                    of_bytes.update(own.decode(ids))
                    total += len(ids)
                for column, value in zip(out, (total, of_ids.hexdigest(), of_bytes.hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(a), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], names=schema.names,
            )

    return narrow.mapInArrow(run, schema)
