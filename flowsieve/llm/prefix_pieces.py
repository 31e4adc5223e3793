"""SentencePiece BPE encoding by a table of the last token of each prefix, and decoding.

The merges of a text end in one sequence of tokens, and a part of that sequence
is what the merges of its own text end in. So each prefix has one last token: of
the pieces that an automaton finds to end there, the one that stays apart from
the last token of the prefix before it. Ids are recovered backwards from the end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from flowsieve.llm.common import fresh, slices

MARK = "▁"
#: Bounds of a worker: characters of the parts it remembers, longest part kept, pairs of tokens it remembers.
CACHE_CHARS, CACHED_CHARS, PAIRS = 8_000_000, 48, 1_000_000
#: Parts of a text handled at once.
SLICE = 50_000
#: Stands for a character without a piece, or for the start.
NONE = -1
NEVER = float("-inf")


class PrefixCoder:
    """Encoder of one worker for a BPE model with the identity normaliser and byte fallback.

    Every character of a longer piece must be a piece itself, so a character
    without a piece joins nothing and cuts the text. Other models are an error.
    """

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        normal = {p.piece: at for at, p in enumerate(proto.pieces) if p.type == p.NORMAL}
        alien = [p.piece for p in proto.pieces if p.type in (p.USER_DEFINED, p.UNUSED)]
        if (
            trainer.model_type != trainer.BPE or not trainer.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces
            or not norm.escape_whitespaces or trainer.treat_whitespace_as_suffix or alien or any(c not in normal for p in normal for c in p)
        ):
            raise ValueError("the model must be plain BPE with byte fallback and without normalisation")
        self.score = {p: proto.pieces[at].score for p, at in normal.items()}
        self.pieces = [p.piece for p in proto.pieces]
        self.single = {p: at for p, at in normal.items() if len(p) == 1}
        self.of_byte = {int(p.piece[3:5], 16): at for at, p in enumerate(proto.pieces) if p.type == p.BYTE}
        self.automaton = ahocorasick.Automaton()
        for piece, at in normal.items():
            self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()
        self.end = next((at for at, p in enumerate(proto.pieces) if p.piece == "</s>"), None)
        self.prefix = MARK if norm.add_dummy_prefix else ""
        # No piece reaches over a cut: before a mark that follows another character, and around a line feed that no longer piece holds.
        feed = "" if any("\n" in p and len(p) > 1 for p in normal) else "\n"
        cuts = not any(MARK in p.lstrip(MARK) for p in normal)
        self.parts = re.compile((f"{feed}|" if feed else "") + f"{MARK}+[^{MARK}{feed}]*|[^{MARK}{feed}]+") if cuts else re.compile(".+", re.S)
        self.sides: dict[int, tuple | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merges(self, piece: str) -> tuple | None:
        """How the letters of a piece merge when it stands alone; None if they do not end as that piece.

        For the left and for the right end: the symbols that stand there one
        after the other, and the least score among the merges up to the next one.
        """
        symbols, score = list(piece), self.score.get
        ends, least = ([symbols[0]], [symbols[-1]]), ([], [])
        running = [float("inf"), float("inf")]
        while len(symbols) > 1:
            found = [score(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
            best = max(found)
            if best == NEVER:
                return None
            at = found.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            for side, place in ((0, 0), (1, -1)):
                running[side] = min(running[side], best)
                if symbols[place] != ends[side][-1]:
                    ends[side].append(symbols[place])
                    least[side].append(running[side])
                    running[side] = float("inf")
        return (ends[0], [*least[0], NEVER]), (ends[1], [*least[1], NEVER])

    def _side(self, token: int) -> tuple | None:
        if token not in self.sides:
            self.sides[token] = self.merges(self.pieces[token])
        return self.sides[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side both stay as they are.

        The two sides merge independently until a symbol of the right end of one
        and of the left end of the other merge. They do if their score is above
        the least that the left side, and not below the least that the right side, needs for its next symbol there.
        """
        known = self.pairs.get((left, right))
        if known is None:
            known = self._side(right) is not None if left == NONE else self._apart(left, right)
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        one, two = self._side(left), self._side(right)
        if one is None or two is None:
            return False
        (a, least_a), (b, least_b) = one[1], two[0]
        p = q = 0
        while True:
            across, need_a, need_b = self.score.get(a[p] + b[q]), least_a[p], least_b[q]
            if across is not None and across > need_a and across >= need_b:
                return False
            if need_a == need_b == NEVER:
                return True
            if need_a >= need_b:
                p += 1
            else:
                q += 1

    def part(self, text: str) -> list[int]:
        """Ids of a part of a text, its blanks written as marks."""
        last, size = [NONE] * (len(text) + 1), [1] * (len(text) + 1)
        done, known = 0, self.pairs.get
        for at, (length, token) in self.automaton.iter(text):
            if done <= at:
                pair = last[at + 1 - length], token
                apart = known(pair)
                if self.apart(*pair) if apart is None else apart:
                    done = at + 1
                    last[done], size[done] = token, length
        ids: list[int] = []
        at = len(text)
        while at:
            if last[at] == NONE:
                ids.extend(self.of_byte[b] for b in reversed(text[at - 1].encode()))
            else:
                ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def split(self, text: str) -> Iterator[list[str]]:
        """Parts of a whole text that are encoded one by one, in slices."""
        if text:
            marked = self.prefix + text.replace(" ", MARK)
            found = iter(self.parts.findall(marked)) if len(text) <= 1 << 20 else (m.group() for m in self.parts.finditer(marked))
            while part := list(islice(found, SLICE)):
                yield part


class Decimals(dict):
    """What a worker has met: part to its ids as decimals joined by blanks. A full memory starts anew."""

    def __init__(self, coder: PrefixCoder):
        super().__init__()
        self.coder, self.held = coder, 0

    def __missing__(self, part: str) -> str:
        ids = " ".join(map(str, self.coder.part(part)))
        if len(part) <= CACHED_CHARS:
            if self.held >= CACHE_CHARS:
                self.clear()
                self.held = 0
            self[part] = ids
            self.held += len(part)
        return ids


class Decoder:
    """Text of ids as the library gives it: marks are blanks, the added first one goes, control pieces are nothing."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.prefix = b" " if proto.normalizer_spec.add_dummy_prefix else b""
        self.bytes: dict[str, bytes] = {}
        for at, p in enumerate(proto.pieces):
            if p.type == p.BYTE:
                self.bytes[str(at)] = bytes([int(p.piece[3:5], 16)])
            elif p.type == p.CONTROL:
                self.bytes[str(at)] = b""
            elif p.type == p.NORMAL:
                self.bytes[str(at)] = p.piece.replace(MARK, " ").encode()

    def slice(self, decimals: list[str]) -> bytes:
        """Bytes of ids that came from a text; the first blank of all is still there."""
        return b"".join(map(self.bytes.__getitem__, decimals))


_CODERS: dict[str, tuple[Decimals, Decoder]] = {}


def _worker(model, name: str) -> tuple[Decimals, Decoder]:
    """The worker's tables for a broadcast model; only the latest are kept."""
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = Decimals(PrefixCoder(model.value)), Decoder(model.value)
    return _CODERS[name]


def _shipped(df: DataFrame, path: str):
    with open(path, "rb") as file:
        model = file.read()
    PrefixCoder(model)  # an unfit model is an error here, not in the tasks
    return df.sparkSession.sparkContext.broadcast(model), hashlib.sha256(model).hexdigest()


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "ids", end: bool = True) -> DataFrame:
    """The frame with the ids of each whole text as an array, an end id last if wanted. Null counts as empty. Replaces a column of that name."""
    model, name = _shipped(df, path)
    keep = [c for c in df.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = _worker(model, name)
        last = [known.coder.end] if end else []
        for batch in slices(batches, text, 1 << 20):
            rows = []
            for row in batch.column(text):
                joined = [" ".join(map(known.__getitem__, part)) for part in known.coder.split(row.as_py() or "")]
                rows.append(np.concatenate([*(np.array(j.split(), np.int32) for j in joined), np.array(last, np.int32)]))
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], found], names=[*keep, ids])

    schema = T.StructType([*[f for f in df.schema.fields if f.name != ids], T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with the text of any id array, as the library decodes it; null counts as empty."""
    model, name = _shipped(df, path)
    keep = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _worker(model, name)[1].library
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = [library.decode(row.as_py() or []) or "" for row in batch.column(ids)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(rows, pa.string())], names=[*keep, out])

    return df.mapInArrow(run, T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.StringType())]))


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens with the end id, ids_sha256 of the decimal ids and decoded_sha256 of the text they decode to.

    Each text is encoded whole, slice by slice, and each slice is decoded from
    its ids, so memory does not follow the length of a text. Null counts as
    empty; repeated rows and null keys stay. No shuffle.
    """
    model, name = _shipped(df, path)
    a, b = fresh(df.select(f"`{key}`"), "a", "b")
    narrow = df.select(F.col(f"`{key}`").alias(a), F.col(f"`{text}`").alias(b))
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, decoder = _worker(model, name)
        last = str(known.coder.end)
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for row in batch.column(b):
                total, of_ids, of_text = 1, hashlib.sha256(), hashlib.sha256()
                for part in known.coder.split(row.as_py() or ""):
                    joined = " ".join(map(known.__getitem__, part))
                    ids = joined.split(" ")
                    decoded = decoder.slice(ids)
                    of_text.update(decoded[len(decoder.prefix) :] if total == 1 else decoded)
                    of_ids.update(joined.encode() + b" ")
                    total += len(ids)
                of_ids.update(last.encode())
                for column, value in zip(out, (total, of_ids.hexdigest(), of_text.hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(a), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], names=schema.names,
            )

    return narrow.mapInArrow(run, schema)
