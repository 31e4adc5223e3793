"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 2**(r+1) - 1 bit masks keeps the positions whose vector has odd
product with the mask's vector. Any r positions span fewer than r + 1
dimensions, so some mask hides all of them: two fingerprints that differ in at
most r bits agree under some mask, without exception.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.llm.common import BLANKS, ascii_lower, discard, fresh, save, slices
from flowsieve.llm.words import mix, scan

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Fingerprints of one bucket compared in one task; larger buckets are cut into blocks and block pairs.
BLOCK = 2048
#: Shingles hashed at once, so a long text needs little memory.
SLICE = 1 << 16
#: Stands for a missing id where one document of a group is chosen; real ids are smaller.
NO_ID = 1 << 62
#: Near copies in the pipeline: words of a shingle, and bands of min-hashes. A pair at similarity 0.8 agrees in no band
#: with chance (1 - 0.8 ** 5) ** 40 = 1.3e-7, whatever its texts; a pair above it with less.
NEAR_SHINGLE, BANDS, BAND_ROWS = 5, 40, 5
#: Pairs a row of the buckets up to which all pairs are compared at once; beyond it, rounds with heads come first, and
#: buckets of more texts than a size go by rare shingles.
NEAR_PAIRS, ROUNDS, SMALL = 4, 3, 16
_TURNS = np.random.default_rng(7).integers(1, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def simhash(text: str, size: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is set if it is set in over half of the shingle hashes; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total, ones = len(words) - size + 1, np.zeros(BITS, np.int64)
    for at in range(0, total, SLICE):
        part = words[at : at + SLICE + size - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(size)]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "fp") -> DataFrame:
    """Per row the key and the fingerprint as a signed long. Null counts as empty; texts are taken whole."""
    narrow = df.select(F.col(f"`{key}`").alias("a"), F.col(f"`{text}`").alias("b"))
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([simhash(row.as_py() or "") for row in batch.column("b")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("a"), pa.array(marks)], names=[key, out])

    return narrow.mapInArrow(run, schema)


def covering_masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """Masks of the construction, the vectors dealt evenly to the positions; zero is no vector."""
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(bits) if ((1 + i % vectors) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def forest(marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected at the radius: one fewer than the size of each group."""
    left, right = [], []
    rest = marks
    while len(rest) > 1:
        frontier, rest = rest[:1], rest[1:]
        while len(frontier) and len(rest):
            near = np.bitwise_count(rest ^ frontier[0]) <= radius
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), frontier[0]))
                right.append(found)
                rest = rest[~near]
                frontier = np.concatenate([frontier, found])
            frontier = frontier[1:]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links(nodes: DataFrame, fp: str = "fp", radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that are connected at the radius.

    A bucket is the fingerprints with equal bits under one mask. Buckets of more
    than ``block`` fingerprints are dealt into blocks, and every pair of blocks
    is one group, so no task holds more than two blocks and no link is missed.
    """
    signed = [m - (1 << 64) if m >> 63 else m for m in covering_masks(BITS, radius)]
    keyed = nodes.select(F.col(fp).alias("fp"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col(fp).bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)
    ])).alias("k")).select("fp", "k.mask", "k.bits")
    sizes = keyed.groupBy("mask", "bits").count().filter(F.col("count") > 1)
    cut = save(sizes.select("mask", "bits", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "simhash-buckets")
    dealt = keyed.join(cut, ["mask", "bits"]).withColumn("i", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = dealt.select("mask", "bits", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "fp")
    grouped = grouped.repartition("mask", "bits", "i", "j").sortWithinPartitions("mask", "bits", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 5), np.int64)
        for batch in _ended(batches):
            rows = held if batch is None else np.concatenate([held, batch])
            ends = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            cuts = [0, *ends.tolist()] + ([len(rows)] if batch is None else [])
            a, b = [], []
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if end - start > 1:
                    left, right = forest(rows[start:end, 4].view(np.uint64), radius)
                    a.append(left.view(np.int64))
                    b.append(right.view(np.int64))
            held = rows[cuts[-1]:]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return grouped.mapInArrow(run, "a long, b long")


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray | None]:
    """Batches as number matrices, then None."""
    for batch in batches:
        yield np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
    yield None


def components(edges: DataFrame, most: int = 100) -> DataFrame:
    """Per node of the links its component, named by the least node: (node, root).

    Alternating large-star and small-star rounds; each is saved, so lineage
    stays short. Minima are combined before the shuffle.
    """
    now = save(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    for _ in range(most):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Minima are joined by broadcast while small, and with skew handling beyond that.
        first = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(first, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = save(large.filter("a != b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b")
        before, now = now, save(small.distinct(), "small-star")
        discard(before, large)
        # Done when all are stars: a node has one link upwards, and none if another has a link to it.
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            now.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.filter((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def group_by_simhash(prints: DataFrame, key: str, fp: str = "fp", out: str = "component_id") -> DataFrame:
    """Fingerprints with the least key of all documents reachable over links, itself included.

    Only fingerprints that are shared or linked are joined back; any other row is
    its own component. Null keys are ignored in the minimum, so a group of none
    but null keys has a null component.
    """
    nodes = save(prints.groupBy(fp).agg(F.min(key).alias("low"), F.count("*").alias("n")), "fingerprints")
    found = components(links(nodes, fp))
    member = nodes.join(found, nodes[fp] == found["node"], "left").withColumn("root", F.coalesce("root", fp))
    member = member.filter((F.col("n") > 1) | F.col("node").isNotNull()).select(fp, "low", "root")
    member = save(member, "members")
    low = save(member.groupBy("root").agg(F.min("low").alias("of")), "lowest")
    owner = save(member.join(low, "root").select(F.col(fp).alias("_fp"), F.col("of").alias("_of"), F.lit(True).alias("_in")), "components")
    joined = prints.join(owner, prints[fp] == owner["_fp"], "left")
    return joined.withColumn(out, F.when(F.col("_in"), F.col("_of")).otherwise(F.col(key))).drop("_fp", "_of", "_in")


def components_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, fingerprint (16 hex digits) and component_id. Texts without words share fingerprint zero."""
    prints = save(fingerprints(df, key, text), "simhash")
    grouped = group_by_simhash(prints, key)
    return grouped.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles of a text with the given word hashes, each once; fewer words are one shingle."""
    size = min(NEAR_SHINGLE, len(words))
    grams = np.zeros(len(words) - size + 1 if size else 0, np.uint64)
    for k in range(size):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(grams)]
    return np.unique(mix(grams))


def bands(grams: np.ndarray) -> np.ndarray:
    """Bucket of the shingles in each band: a hash of the least of each of its min-hashes."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(grams), 1 << 11):
        least = np.minimum(least, (grams[None, at : at + (1 << 11)] * _TURNS[:, None]).min(1))
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + least[k::BAND_ROWS])
    return keys


def _per_text(df: DataFrame, keep: str, made: Callable[[np.ndarray], np.ndarray], out: str, schema: str) -> DataFrame:
    """Columns of numbers as they are, and for ``text`` an array made of its shingles. Texts are taken whole."""
    names = keep.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", 1 << 20):
            found = scan([(row.as_py() or "").encode().lower() for row in rows.column("text")])
            parts = [made(shingles(found.hashes[a:b])) for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True)]
            ends = pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
            flat = pa.array(np.concatenate(parts).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], pa.ListArray.from_arrays(ends, flat)], names=[*names, out])

    return df.select(*names, "text").mapInArrow(run, schema)


def near_buckets(nodes: DataFrame) -> DataFrame:
    """(key, node) of all texts that share a band with another text."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a != b").select("key")
    return keyed.join(save(shared, "near-shared"), "key")


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of texts whose shingle sets are similar at 0.8 or more: 9 common >= 4 (of a + of b).

    The sets of the side a are cut to those in the pairs. Where these are few, as
    the heads of a round, Spark sends them to the sets of b, and no set is shuffled once a pair.
    """
    heads = save(sets.join(pairs.select("a").distinct(), sets["node"] == F.col("a"), "left_semi"), "near-heads")
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("of_b")), "b")
    both = both.join(heads.select(F.col("node").alias("a"), F.col("grams").alias("of_a")), "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.filter(9 * common >= 4 * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def print_pairs(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts that connect all whose fingerprints are connected at the radius, from (node, fp).

    Every text goes with the least of its fingerprint, and that one with those of linked fingerprints.
    """
    of = save(prints.groupBy("fp").agg(F.min("node").alias("low")), "near-fingerprints")
    same = prints.join(of, "fp").filter("node != low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    linked = save(links(of).distinct(), "near-fingerprint-links")
    for side in ("a", "b"):
        linked = linked.join(of.select(F.col("fp").alias(side), F.col("low").alias(f"of_{side}")), side)
    return save(same.unionByName(linked.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))).distinct(), "near-fingerprint-pairs")


def print_candidates(pairs: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Of the pairs that span the components of fingerprints: pairs (a, b) to compare, and buckets (key, node) for the rest.

    Two texts of a component may be alike where the pairs between them are not. So a component of at most
    ``most`` texts gives all its pairs, and a larger one is a bucket.
    """
    of = save(components(pairs), "near-fingerprint-components")
    sized = of.join(of.groupBy("root").agg(F.count("*").alias("n")), "root")
    small = sized.filter(F.col("n") <= most)
    inside = small.join(small.select("root", F.col("node").alias("b")), "root").filter("node < b").select(F.col("node").alias("a"), "b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(inside)
    return save(pairs.distinct(), "near-fingerprint-candidates"), sized.filter(F.col("n") > most).select(F.xxhash64(F.lit("fingerprints"), "root").alias("key"), "node")


def near_components(buckets: DataFrame, sets: DataFrame, rounds: int = ROUNDS, first: DataFrame | None = None) -> DataFrame:
    """Per linked text its component: (node, root). Texts are linked if :func:`alike` says so.

    ``first`` are links that are known, as those by fingerprint. Pairs of texts that are connected already need no comparison. Where too many
    others are left, some rounds compare the texts of each bucket with a few heads
    of it, other ones each time. Pairs that are still open then come from small
    buckets as they are, and from large ones by an index of rare shingles, as they
    do once a round links nothing.
    """
    found, links = None, []
    if first is not None and not first.isEmpty():
        found, links = components(first), [first]
    for turn in range(rounds + 1):
        member = buckets.withColumn("root", F.col("node"))
        if found is not None:
            of = found.select("node", F.col("root").alias("of"))
            member = save(buckets.join(of, "node", "left").select("key", "node", F.coalesce("of", "node").alias("root")), "near-members")
        sizes = member.groupBy("key", "root").agg(F.count("*").cast("double").alias("n"))
        sizes = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same")).filter("n * n > same")
        left, rows = sizes.agg(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2), F.sum("n")).first()
        if not left:
            return found if found is not None else components(buckets.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
        few = left <= NEAR_PAIRS * rows
        if few or turn == rounds:
            break
        pairs = save(_heads(member, turn), "near-stars")
        new = save(alike(pairs, sets), "near-links")
        discard(pairs)
        if new.isEmpty():
            break
        links.append(new)
        found = components(_all(links))
    # Where pairs are few the plan is one join of the buckets; else buckets above a size go by rare shingles.
    open_ = member.join(sizes.select("key", "n"), "key")
    small = open_ if few else open_.filter(F.col("n") <= SMALL)
    other = small.select("key", F.col("node").alias("b"), F.col("root").alias("root_b"))
    pairs = small.join(other, (small["key"] == other["key"]) & (F.col("node") < F.col("b")) & (F.col("root") != F.col("root_b")))
    pairs = pairs.select(F.col("node").alias("a"), "b")
    if not few:
        large = save(open_.filter(F.col("n") > SMALL).select("node", "root").distinct(), "near-large")
        pairs = pairs.unionByName(rare_pairs(large.join(sets, "node")))
    return components(_all([*links, alike(save(pairs.distinct(), "near-pairs"), sets)]))


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _heads(member: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b): texts b of a bucket with its two heads a, the first ones by a hash that changes every turn.

    Buckets that share texts mostly share their heads, so there are few of them and few pairs a text.
    """
    rank = F.xxhash64("node", F.lit(turn))
    first = F.min(F.struct(rank.alias("rank"), "node", "root"))
    one = member.groupBy("key").agg(first.alias("one"))
    rest = member.join(one, "key")
    # The second head is of another component, so the texts of the first head's own component meet one too.
    two = rest.filter("root != one.root").groupBy("key").agg(first.alias("two"))
    both = rest.join(two, "key")
    heads = F.inline(F.array("one", "two"))
    pairs = both.select(F.col("node").alias("b"), F.col("root").alias("of"), heads).filter("root != of")
    return pairs.select(F.col("node").alias("a"), "b").distinct()


def rare_pairs(texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of (node, root, grams) with different roots that may be similar at 0.8; none that is is missing.

    Shingles are ordered by their number of texts. The first common one of two
    similar texts is among the first fifth of the longer and the first ninth of
    the shorter, since as many must follow as the pair needs; so texts that differ in
    their rare shingles never meet in a shingle that all of them share. Within a
    shingle only texts outside its most frequent component look for partners.
    """
    size = F.size("grams")
    long = texts.select("node", "root", size.alias("size"), F.explode("grams").alias("gram"))
    counts = save(long.groupBy("gram").agg(F.count("*").alias("df")), "near-gram-counts")
    ordered = long.join(counts, "gram").groupBy("node", "root", "size").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("grams"))
    probes = F.slice("grams", 1, (F.col("size") - F.ceil(F.col("size") * 4 / 5) + 1).cast("int"))
    entries = ordered.select("node", "root", "size", F.posexplode(probes).alias("at", "g")).filter("g.df > 1")
    indexed = F.col("at") <= F.col("size") - F.ceil(F.col("size") * 8 / 9)
    entries = save(entries.select("node", "root", "size", "at", F.col("g.gram").alias("gram"), indexed.alias("indexed")), "near-entries")
    roots = entries.groupBy("gram", "root").agg(F.count("*").alias("n")).groupBy("gram").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).filter("roots > 1")
    x = entries.join(save(roots.select("gram", "main"), "near-grams"), "gram").filter("root != main").alias("x")
    y = entries.alias("y")
    longer = (F.col("x.size") > F.col("y.size")) | ((F.col("x.size") == F.col("y.size")) & (F.col("x.node") > F.col("y.node")))
    need = (F.col("x.size") + F.col("y.size")) * 4
    rest = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))  # places count from 0, so it is one itself
    once = (F.col("y.root") == F.col("x.main")) | (F.col("x.node") < F.col("y.node"))
    meets = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.root") != F.col("y.root")) & once & (rest * 9 >= need)
    return x.join(y, meets & F.when(longer, F.col("y.indexed")).otherwise(F.col("x.indexed"))).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies, the one with the least key, with the columns it came with.

    Near copies share four fifths of their five-word shingles, A to Z in either
    case; a text of fewer words is one shingle. Texts whose SimHash fingerprints are
    connected are compared first, in large groups along the links that connect them; then those of such groups and
    those that share a band of min-hashes, if they are not linked yet: fingerprints at the radius miss some.
    Every link is checked on the two whole sets. Rows with equal key and words count once; other texts of a key are documents of their own.
    Documents without a key are told apart by their text and come after all others.
    """
    ident, words, loser, lost = fresh(docs, "ident", "words", "loser", "lost")
    named = docs.withColumns({ident: _ident(F.col(f"`{key}`"), F.col(f"`{text}`")), words: _node(F.col(f"`{text}`"))})
    narrow = named.select(F.col(ident).alias("id"), F.col(words).alias("node"), F.col(f"`{text}`").alias("text"))
    found = save(_per_text(narrow, "id node", bands, "keys", "id long, node long, keys array<long>"), "profiles")
    nodes = save(found.groupBy("node").agg(F.min("id").alias("low"), F.count("*").alias("n"), F.first("keys").alias("keys")), "near-texts")
    pairs = print_pairs(save(fingerprints(narrow, "node").distinct(), "near-prints"))
    pairs, groups = print_candidates(pairs, SMALL)
    buckets = save(near_buckets(nodes).unionByName(groups), "near-buckets")
    # The texts to compare grow with the documents, so one plan at every size.
    compared = _all([buckets.select("node"), pairs.select(F.col("a").alias("node")), pairs.select(F.col("b").alias("node"))]).distinct()
    wanted = save(nodes.join(compared, "node").select("node", F.col("low").alias("id")), "near-wanted").hint("shuffle_merge")
    sets = _per_text(narrow.join(wanted, ["id", "node"]), "node", lambda grams: grams, "grams", "node long, grams array<long>")
    sets = save(sets.dropDuplicates(["node"]), "near-sets")
    first = save(alike(pairs, sets), "near-fingerprint-alike")
    linked = near_components(buckets, sets, first=first).withColumnRenamed("node", "of")
    member = nodes.select("node", "low", "n").join(linked, F.col("node") == F.col("of"), "left")
    member = save(member.filter("n > 1 or of is not null").select("node", "low", F.coalesce("root", "node").alias("root")), "members")
    # A key may come with several texts, so the rows to drop are told by both.
    lowest = save(member.groupBy("root").agg(F.min(F.struct("low", "node")).alias("first")), "lowest")
    owner = save(member.join(lowest, "root").select(F.col("node").alias("of"), F.col("first.low").alias("first"), F.col("first.node").alias("best")), "owners")
    losers = found.select("id", "node").join(owner, F.col("node") == F.col("of")).filter("id != first or node != best")
    losers = losers.select(F.col("id").alias(loser), F.col("node").alias(lost)).distinct()
    losers = save(losers, "near-copies").hint("shuffle_merge")  # it grows with the documents, so one plan at every size
    kept = named.join(losers, (named[ident] == losers[loser]) & (named[words] == losers[lost]), "left_anti")
    twice = save(found.groupBy("id").count().filter("count > 1").select(F.col("id").alias(loser)), "repeated-keys")
    if not twice.isEmpty():
        once = kept.join(twice, kept[ident] == twice[loser], "left_semi").dropDuplicates([ident, words])
        kept = kept.join(twice, kept[ident] == twice[loser], "left_anti").unionByName(once)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def _node(text: Column) -> Column:
    """Hash of the words of a text, A to Z in either case."""
    return F.xxhash64(F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), f"[{BLANKS}]+", " ")))


def _ident(key, text):
    by_text = F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(NO_ID)
    return F.coalesce(key.cast("long"), by_text)
