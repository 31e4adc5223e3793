"""URL allow and block rules in a sorted digest array.

Rule keys (host followed by path) are stored as sorted 64-bit xxhash digests
beside the full strings. Workers memory-map the array, probe all candidate
keys of a batch by binary search, and confirm every hit on the stored string.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.llm.common import ascii_lower, fresh, save

_MAPPED: dict[str, tuple] = {}


def url_host(url: Column) -> Column:
    """Lower-cased text between the first ``://`` and ``/``, ``?``, ``#`` or the end; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def clean_rules(rules: DataFrame) -> DataFrame:
    """Usable rules as (key, action, host_chars, path_chars, labels, digest), one row per key.

    A rule without a host, with a path that is not empty and does not start with
    ``/``, or with another action than ``allow`` or ``block`` can fit no URL and
    is left out. Of contradicting rules with one key, ``block`` stays.
    """
    host, path = ascii_lower(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    return (
        rules.filter((host != "") & ((path == "") | path.startswith("/")) & F.col("action").isin("allow", "block"))
        .groupBy(F.concat(host, path).alias("key"), F.length(host).alias("host_chars"), F.length(path).alias("path_chars"), _labels(host).alias("labels"))
        .agg(F.max("action").alias("action"))  # "block" sorts after "allow"
        .withColumn("digest", F.xxhash64("key"))
    )


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def pack(rows: pa.Table) -> bytes:
    """Digest array, string offsets, precedence, actions and strings in one byte block."""
    rows = rows.sort_by("digest").combine_chunks()
    raw = [k.encode() for k in rows["key"].to_pylist()]
    offsets = np.cumsum([0, *map(len, raw)], dtype=np.int64)
    rank = rows["key_chars"].to_numpy().astype(np.int64) << 32 | rows["host_chars"].to_numpy().astype(np.int64)
    return b"".join([
        np.int64(len(raw)).tobytes(), rows["digest"].to_numpy().astype(np.int64).tobytes(), offsets.tobytes(),
        rank.tobytes(), np.array([a == "block" for a in rows["action"].to_pylist()], np.int64).tobytes(), b"".join(raw),
    ])


def mapped(token: str, block) -> tuple:
    """Memory-map a broadcast block, once per worker. The file has no name left, so nothing stays behind."""
    if token not in _MAPPED:
        fd, name = tempfile.mkstemp()
        with os.fdopen(fd, "wb") as out:
            out.write(block.value)
        whole = np.memmap(name, np.uint8, "r")
        os.unlink(name)
        n = int(whole[:8].view(np.int64)[0])
        cuts = np.cumsum([8, 8 * n, 8 * (n + 1), 8 * n, 8 * n])
        digests, offsets, rank, blocks = (whole[a:b].view(np.int64) for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        strings = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(whole[cuts[-1]:]))
        _MAPPED[token] = (digests, strings, rank, blocks)
    return _MAPPED[token]


def probe(index: tuple, digests: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Index of each candidate in the array, or -1: binary search, then the stored strings decide."""
    stored, strings, _, _ = index
    found = np.full(len(digests), -1, np.int64)
    if not len(stored) or not len(digests):
        return found
    at = np.searchsorted(stored, digests)
    while True:  # one more turn for each further rule with an equal digest
        live = np.flatnonzero((found < 0) & (at < len(stored)))
        live = live[stored[at[live]] == digests[live]]
        if not len(live):
            return found
        same = pc.equal(keys.take(pa.array(live)).cast(pa.large_string()), strings.take(pa.array(at[live]))).to_numpy(zero_copy_only=False)
        found[live[same]] = at[live[same]]
        at[live] += 1


def filter_urls(df: DataFrame, rules: DataFrame, url: str = "url", index_bytes: int = 256 << 20) -> DataFrame:
    """Every row with host, path, the rule that decides (null if none) and the verdict.

    A rule (host, path, action) fits its host and all subdomains where the path
    starts with the rule's path. The longest key wins, of equal ones the longer
    host. A URL that no rule fits is in no list, so it is allowed. A null URL,
    or one without ``://``, has an empty host and path and is allowed too. Input
    columns named host, path, rule or verdict are replaced; others, and repeated
    rows, stay. No shuffle: the packed rules are broadcast when they have at most
    ``index_bytes``; a longer list is joined instead, on digest and string.
    """
    rules = save(clean_rules(rules), "url-rules")
    size = rules.agg(
        F.sum(F.octet_length("key") + 40).alias("size"), F.array_sort(F.collect_set("path_chars")).alias("lengths"),
        F.array_sort(F.collect_set("labels")).alias("labels"),
    ).first()
    keep = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = df.select(*[F.col(f"`{c}`") for c in keep], url_host(F.col(f"`{url}`")).alias("host"), url_path(F.col(f"`{url}`")).alias("path"))
    if not size["size"]:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    cands, digests = fresh(parts, "candidates", "digests")
    if size["size"] > index_bytes:
        return _joined(parts, rules, size["labels"], size["lengths"], cands)
    rows = rules.select("key", "action", "host_chars", F.length("key").alias("key_chars"), "digest").toArrow()
    block, token = df.sparkSession.sparkContext.broadcast(pack(rows)), uuid.uuid4().hex
    names = parts.columns
    schema = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = mapped(token, block)
        for batch in batches:
            keys, hashes = batch.column(cands), batch.column(digests)
            lengths = pc.list_value_length(keys).to_numpy(zero_copy_only=False)
            hit = probe(index, hashes.flatten().to_numpy(zero_copy_only=False), keys.flatten())
            best = np.full(batch.num_rows, -1, np.int64)
            score = np.where(hit >= 0, index[2][hit], -1)
            owner = np.repeat(np.arange(batch.num_rows), lengths)
            order = np.lexsort((score, owner))
            last = order[np.flatnonzero(np.diff(owner[order], append=-1))]  # the best candidate of each row
            best[owner[last]] = hit[last]
            none = pa.array(best < 0)
            picked = pa.array(np.where(best < 0, 0, best))
            rule = pc.if_else(none, pa.scalar(None, pa.string()), index[1].take(picked).cast(pa.string()))
            verdict = pa.array(np.where((best >= 0) & (index[3][np.maximum(best, 0)] == 1), "block", "allow"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], rule, verdict], names=[*names, "rule", "verdict"])

    probed = parts.withColumn(cands, candidates(size["labels"], size["lengths"]))
    return probed.withColumn(digests, F.transform(cands, lambda key: F.xxhash64(key))).mapInArrow(judge, schema)


def candidates(labels: list[int], lengths: list[int]) -> Column:
    """Keys of all rules that could fit: host suffixes of as many labels as some rule has, with path prefixes of a length some rule has.

    So their size is that of the URL times the number of different rule shapes, however many labels a host has.
    """
    suffixes = F.array_compact(F.array(*[F.when(_labels(F.col("host")) >= n, F.substring_index("host", ".", -n)) for n in labels]))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _joined(parts: DataFrame, rules: DataFrame, labels: list[int], lengths: list[int], cands: str) -> DataFrame:
    """The same verdicts by a join of the distinct (host, path) pairs, for lists too long to broadcast."""
    pairs = parts.select("host", "path").distinct()
    found = (
        pairs.select("host", "path", F.explode(candidates(labels, lengths)).alias("key")).withColumn("digest", F.xxhash64("key"))
        .join(rules, ["digest", "key"])
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("key"), "host_chars", "key", "action")).alias(cands))
    )
    joined = parts.join(found, ["host", "path"], "left")
    return joined.select(
        *[f"`{c}`" for c in parts.columns], F.col(cands)["key"].alias("rule"), F.coalesce(F.col(cands)["action"], F.lit("allow")).alias("verdict")
    )
