"""Documents of similar shingle sets: covering masks over min-hash symbols, and exact similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.components import components
from tableflow.llm.rows import keyed, stored
from tableflow.llm.simhash import covering_masks, fingerprint, links
from tableflow.llm.text import SPACED, Words, chunks, mix

SYMBOLS = 12
RADIUS = 3
SETS = 4
RARE = 32
LOWERED = SPACED.copy()
LOWERED[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def _shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle, in order of rows; a row of fewer words is one shingle."""
    grams, whole = words.grams(size)
    hashes, rows = [grams[whole]], [words.row[: len(grams)][whole]]
    for fewer in range(1, size):
        short = np.flatnonzero(words.counts == fewer)
        if len(short):
            own, _ = words.grams(fewer)
            hashes.append(own[words.bounds[short]])
            rows.append(short)
    hashes, rows = np.concatenate(hashes), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return hashes[order], rows[order]


def bucket_keys(text: Column, size: int) -> Column:
    """Column: per table of masks a hash of the symbols it keeps, null without words. The symbols are
    ``SETS`` times ``SYMBOLS`` min-hashes of a text's shingles.

    Made here, as sixty hash expressions take much of the driver's memory when they are planned and compiled."""
    factors = mix(np.arange(1, SETS * SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)
    places = np.arange(SETS * SYMBOLS, dtype=np.uint64) << np.uint64(32)
    tables = _masks()
    kept = np.zeros((SETS * SYMBOLS, len(tables)), dtype=np.uint64)
    for t, own in enumerate(tables):
        kept[own, t] = 1
    seeds = mix(np.arange(1, len(tables) + 1, dtype=np.uint64))

    @F.arrow_udf("array<long>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for rows, data, begins in chunks(texts):
                hashes, row = _shingles(Words(rows, data, begins, LOWERED), size)
                full, first = np.unique(row, return_index=True)
                found = np.empty((len(full), len(factors)), dtype=np.uint64)
                for j, factor in enumerate(factors):
                    if len(full):
                        least = np.minimum.reduceat(hashes * factor ^ (hashes >> np.uint64(33)), first)
                        found[:, j] = mix(least).astype(np.uint32)
                keys = mix(mix(found | places) @ kept + seeds).view(np.int64)
                part: list = [None] * rows
                for k, r in enumerate(full.tolist()):
                    part[r] = keys[k]
                out += part
            yield pa.array(out, pa.list_(pa.int64()))

    return compute(text)


def shingle_set(text: Column, size: int) -> Column:
    """Column: the distinct hashes of a text's shingles."""

    @F.arrow_udf("array<long>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for rows, data, begins in chunks(texts):
                hashes, row = _shingles(Words(rows, data, begins, LOWERED), size)
                at = np.searchsorted(row, np.arange(rows + 1))
                out += [np.unique(hashes[at[r] : at[r + 1]]).view(np.int64) for r in range(rows)]
            yield pa.array(out, pa.list_(pa.int64()))

    return compute(text)


def _masks() -> list[list[int]]:
    """Per table, the symbols it keeps: within a set, any ``RADIUS`` symbols lie outside some table."""
    kept = [[i for i in range(SYMBOLS) if m >> i & 1] for m in covering_masks(RADIUS)]
    return [[k * SYMBOLS + i for i in own] for k in range(SETS) for own in kept]


def _bucket_ends(placed: DataFrame) -> DataFrame:
    """Per bucket (``key``) of several members (``n``) the least and the greatest, and how many there are."""
    ends = placed.groupBy("key").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("members"))
    # Stored, so that both sides of the joins lie on shuffles of their own and a hot bucket can be split.
    return stored(placed.sparkSession, ends.where("lo <> hi"), "ends")


def _bucket_pairs(placed: DataFrame, ends: DataFrame) -> DataFrame:
    """Pairs of each member of a bucket with the least and with the greatest one, two a member."""
    both = F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in (("lo", "n"), ("n", "hi"))))
    return placed.join(ends, "key").select(F.inline(both)).where("a <> b")


def _unsettled(placed: DataFrame, ends: DataFrame, roots: DataFrame) -> DataFrame:
    """(n, root) of the texts in buckets whose members the links so far (``roots``) don't join into one.
    In a bucket of two, both have been compared."""
    spark = placed.sparkSession
    crowded = placed.join(ends.where("members > 2").select("key"), "key").join(roots, "n")
    crowded = stored(spark, crowded.select("key", "n", "root"), "crowded")
    mixed = crowded.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    mixed = stored(spark, mixed.select("key"), "mixed")
    return stored(spark, crowded.join(mixed, "key").select("n", "root").distinct(), "unsettled")


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(t, c, n, size, rank): the first shingles of the rows (n, set), by which similar ones meet.

    Shingles are ordered by how many of the sets hold them (``c``), rare ones first, and ``rank`` counts from 1.
    Of two sets of the wanted similarity, the first ``|x| - ceil(similarity * |x|) + 1`` shingles of one and of
    the other have one in common. Shingles of one set alone are left out.
    """
    tokens = sets.select("n", F.size("set").alias("size"), F.explode("set").alias("t"))
    counts = tokens.groupBy("t").agg(F.count("*").alias("c")).where("c > 1")
    counts = stored(sets.sparkSession, counts, "shingle-counts")
    order = Window.partitionBy("n").orderBy(F.coalesce("c", F.lit(1)), "t")
    needed = F.ceil(F.col("size") * similarity - 1e-9)
    first = tokens.join(counts, "t", "left").withColumn("rank", F.row_number().over(order))
    first = first.where((F.col("rank") <= F.col("size") - needed + 1) & F.col("c").isNotNull())
    return stored(sets.sparkSession, first.select("t", "c", "n", "size", "rank"), "prefixes")


def _reach(similarity: float) -> Column:
    """Whether sets whose first common shingle is at ``rank`` in one and at ``rank2`` in the other hold enough
    shingles from there on to be similar. Of similar sets, the smaller one is then ``_early``."""
    left = F.least(F.col("size") - F.col("rank"), F.col("size2") - F.col("rank2")) + 1
    return left + 1e-6 >= (F.col("size") + F.col("size2")) * (similarity / (1 + similarity))


def _early(similarity: float) -> Column:
    return F.col("size") - F.col("rank") + 1 + 1e-6 >= F.col("size") * (2 * similarity / (1 + similarity))


def _rare_pairs(first: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different roots in the prefixes (with ``root``): all that can be similar among those with
    a shingle that at most ``RARE`` sets hold, and, to join most of the others soon, each set that holds a
    more frequent one with the smallest, as texts that have but a template in common are similar to the
    one with the least besides, if to any. The rest is left to :func:`_frequent_pairs`.
    """
    rare = first.where(F.col("c") <= RARE).select("t", "n", "root", "size", "rank")
    other = rare.select("t", *(F.col(c).alias(f"{c}2") for c in ("n", "root", "size", "rank")))
    pairs = rare.join(other, "t").where("n < n2 and root <> root2").where(_reach(similarity))
    common = first.where(F.col("c") > RARE)
    smallest = common.groupBy("t").agg(F.min(F.struct("size", "n", "root")).alias("least"))
    smallest = stored(first.sparkSession, smallest, "smallest")
    led = common.join(smallest, "t").where("root <> least.root").select(
        F.least("n", "least.n").alias("a"), F.greatest("n", "least.n").alias("b")
    )
    return pairs.select(F.col("n").alias("a"), F.col("n2").alias("b")).union(led).distinct()


def _frequent_pairs(first: DataFrame, similarity: float) -> DataFrame | None:
    """All pairs (a, b) of different roots in the prefixes (with ``root``) that can be similar and share a shingle
    which more than ``RARE`` sets hold; None if there are none.

    A shingle's holders are not paired within the root that most of them have: of each pair one is outside
    it. The smaller set of a pair has the shingle among still fewer first ones than the prefix.
    """
    spark = first.sparkSession
    common = first.where(F.col("c") > RARE).select("t", "n", "root", "size", "rank", _early(similarity).alias("early"))
    common = stored(spark, common, "frequent")
    roots = common.groupBy("t", "root").agg(F.count("*").alias("members"))
    roots = roots.groupBy("t").agg(F.max(F.struct("members", "root")).alias("most"), F.count("*").alias("roots"))
    # Stored, so that both sides of the joins lie on shuffles of their own and a hot shingle can be split.
    mixed = stored(spark, roots.where("roots > 1").select("t", F.col("most.root").alias("main")), "mixed-shingles")
    if mixed.isEmpty():
        return None
    common = stored(spark, common.join(mixed, "t"), "frequent-mixed")
    # An early shingle meets all, another one only the early ones.
    sides = F.when(F.col("early"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    outside = common.where("root <> main").select("t", "main", "n", "root", "size", "rank", F.explode(sides).alias("early"))
    others = common.select("t", "early", *(F.col(c).alias(f"{c}2") for c in ("n", "root", "size", "rank")))
    pairs = outside.join(others, ["t", "early"]).where("root <> root2 and (root2 = main or n < n2)")
    return pairs.where(_reach(similarity)).select(F.least("n", "n2").alias("a"), F.greatest("n", "n2").alias("b")).distinct()


def _alike(pairs: DataFrame, sets: DataFrame, key: str, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets, found by ``key``, are similar enough."""
    left, right = (sets.select(F.col(key).alias(c), F.col("set").alias(n)) for c, n in (("a", "x"), ("b", "y")))
    both = F.size(F.array_intersect("x", "y"))
    alike = both >= F.lit(similarity) * (F.size("x") + F.size("y") - both)
    return pairs.join(left, "a").join(right, "b").where(alike).select("a", "b")


def _by_root(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``n`` as pairs of their roots."""
    one, two = (roots.select(F.col("n").alias(c), F.col("root").alias(r)) for c, r in (("a", "x"), ("b", "y")))
    return pairs.join(one, "a").join(two, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, similarity: float = 0.8
) -> DataFrame:
    """One row per input row: ``id``, ``version`` (hash of the text) and ``component_id``, the least id
    among the rows that links reach. Texts are linked if the Jaccard similarity of their sets of
    word shingles is at least ``similarity``; texts without words are all alike.

    Candidates come from SimHash fingerprints within two bits, and, since edits that leave a
    similarity of 0.8 change many more bits than two, from covering masks over min-hash symbols: two
    texts that differ in at most ``RADIUS`` of the ``SYMBOLS`` symbols of one of the ``SETS`` sets agree on
    all that some mask keeps. In a bucket each text is first compared with the least and the greatest
    one, so the rows follow the number of texts whatever the size of a bucket, and equal texts are
    one. Texts in buckets that this doesn't join into one are then paired by their rarest shingles.
    Candidates are verified on whole shingle sets.

    A null text has no words. Repeated rows are in one component; a null id is no least id unless
    the component has no other. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = keyed(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), "id", "text")
    signed = stored(spark, docs.select(
        "id", "__id", F.col("__version").alias("version"),
        fingerprint(F.col("text"), size).alias("f"), bucket_keys(F.col("text"), size).alias("keys"),
    ), "signed")
    # Equal texts are one node, named by the least row; those without words are one as well.
    wordless = F.col("keys").isNull()
    same = F.when(wordless, 0).otherwise(F.col("version"))
    signed = signed.withColumns({"same": same, "k": F.when(wordless, 0).otherwise(F.xxhash64("keys"))})
    nodes = signed.groupBy("same", "k").agg(
        F.min(F.struct("__id", F.col("version").alias("__version"))).alias("node"),
        F.min("f").alias("f"), F.min("keys").alias("keys"), F.min("id").alias("id"),
    )
    # In buckets a node goes by a hash; if two share one, both are candidates.
    nodes = stored(spark, nodes.withColumn("n", F.xxhash64("node")), "nodes")
    full = nodes.where("keys is not null")
    # Equal fingerprints are a bucket as well, with those that are linked to it.
    near = links(full, "f").select(F.col("b").alias("f"), F.col("a").alias("key"))
    near = stored(spark, full.select("n", "f").join(near, "f").select("n", "key"), "near")
    placed = full.select("n", F.explode(F.concat("keys", F.array("f"))).alias("key")).union(near)
    ends = _bucket_ends(placed)
    pairs = _bucket_pairs(placed, ends)
    pairs = pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
    one, two = (full.select(F.col("n").alias(c), F.col("node").alias(n)) for c, n in (("x", "a"), ("y", "b")))
    pairs = stored(spark, pairs.join(one, "x").join(two, "y").select("a", "b"), "pairs")
    # Shingle sets of the candidates alone.
    wanted = pairs.select("a.*").union(pairs.select("b.*")).distinct()
    sets = docs.join(wanted.hint("shuffle_hash"), ["__id", "__version"]).select(
        F.struct("__id", "__version").alias("node"), shingle_set(F.col("text"), size).alias("set")
    )
    sets = stored(spark, sets.groupBy("node").agg(F.min("set").alias("set")), "sets")
    found = stored(spark, _alike(pairs, sets, "node", similarity), "similar")
    roots = components(found)
    # Whoever is in a crowded bucket was a candidate, so the sets are there.
    at = full.select("n", "node").join(roots, "node", "left").select("n", F.coalesce("root", "node").alias("root"))
    rest = _unsettled(placed, ends, stored(spark, at, "roots"))
    rest = stored(spark, rest.join(full.select("n", "node"), "n").join(sets, "node").select("n", "root", "set"), "rest")
    first, own = _prefixes(rest, similarity), rest.select("n", "root")
    more = _alike(_rare_pairs(first.join(own, "n"), similarity), rest, "n", similarity)
    # What the first links join goes on as its root: only roots are linked further.
    more = stored(spark, _by_root(more, own).distinct(), "more")
    joined = components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))
    now = own.join(joined, "root", "left").select("n", F.coalesce("top", "root").alias("root"))
    left = _frequent_pairs(first.join(now, "n"), similarity)
    if left is not None:
        last = stored(spark, _by_root(_alike(left, rest, "n", similarity), own).distinct(), "last")
        if not last.isEmpty():
            joined = components(more.union(last)).select(F.col("node").alias("root"), F.col("root").alias("top"))
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.join(joined, "root", "left").withColumn("root", F.coalesce("top", "root"))
    named = stored(spark, named.select("same", "k", "root", "id"), "named")
    least = stored(spark, named.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    named = stored(spark, named.join(least, "root").select("same", "k", "component_id"), "components")
    return signed.join(named, ["same", "k"]).select("id", "version", "component_id")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, similarity: float = 0.8
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the least id
    (nulls last, then by the text's hash) stays; of rows equal in id and text, one."""
    docs = keyed(docs, doc_id, text)
    found = similar_documents(docs, "__id", text, size, similarity)
    kept = found.groupBy("component_id").agg(F.min(F.struct("id", "version")).alias("k"))
    kept = kept.select(F.col("k.id").alias("__id"), F.col("k.version").alias("__version"))
    left = docs.join(kept.hint("shuffle_hash"), ["__id", "__version"]).dropDuplicates(["__id", "__version"])
    return left.drop("__id", "__version")
