"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.components import components
from tableflow.llm.rows import stored

BITS = 64


def _fingerprint(text: bytes, size: int) -> int:
    words = text.lower().split()  # A-Z only, and the six ASCII spaces
    if not words:
        return 0
    if len(words) <= size:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint(text, size: int = 5):
    """Column: the 64-bit SimHash of a text's word shingles.

    Words are runs without ASCII spaces, A-Z lowered; shingles are ``size`` words joined by spaces,
    repeats included; fewer words are one shingle, and none give zero, as does a null. Shingles are
    hashed with XXH64, seed 42; a bit is set where it is set in over half of the hashes.
    """

    @F.arrow_udf("long")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([_fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", size)
                            for t in texts], pa.int64())

    return compute(text)


def covering_masks(radius: int) -> list[int]:
    """Masks such that any ``radius`` bits all lie outside at least one of them.

    Bit i gets a nonzero vector over GF(2) of radius + 1 coordinates, and there is a mask for every
    nonzero vector v: it keeps the bits whose vector isn't orthogonal to v. The vectors of
    ``radius`` bits can't span the space, so some v is orthogonal to all of them, and two
    fingerprints that differ in those bits alone agree under the mask of v.
    """
    last = (1 << (radius + 1)) - 1
    vectors = [1 + i % last for i in range(BITS)]
    return [
        sum(1 << i for i in range(BITS) if (vectors[i] & v).bit_count() % 2)
        for v in range(1, last + 1)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, column: str, radius: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all those within two bits.

    A fingerprint goes to one bucket per mask; those alone in all their buckets have no partner.
    The others differ from their partners only in bits that a shared bucket's mask ignores. Within
    a bucket pairs are not compared: each fingerprint is sent to itself and to those
    one ignored bit away, and two of them meet at such a place exactly if they are within two bits
    of each other. At most 65 fingerprints can meet at one place, and each is linked to the least
    there, so the rows grow with the number of fingerprints whatever the size of a bucket.
    """
    if radius != 2:
        raise ValueError("links are found for a radius of 2 bits")
    distinct = prints.select(F.col(column).alias("f")).distinct()
    masks = covering_masks(radius)
    tables = F.array(*(F.struct(F.lit(_signed(m)).alias("m"), F.col("f").bitwiseAND(F.lit(_signed(m))).alias("k"))
                       for m in masks))
    placed = distinct.select("f", F.explode(tables).alias("t")).select("f", "t.m", "t.k")
    # In a bucket's least and greatest fingerprint shows whether it holds more than one.
    shared = placed.groupBy("m", "k").agg(F.min("f").alias("lo"), F.max("f").alias("hi"))
    # Stored, so that both sides of the join lie on shuffles of their own and a hot bucket can be split.
    shared = stored(prints.sparkSession, shared.where("lo <> hi").select("m", "k"), "buckets")
    ignored = (
        placed.join(shared, ["m", "k"]).groupBy("f").agg(F.bit_or(F.bitwise_not("m")).alias("free"))
    )
    bits = F.array(*(F.lit(_signed(1 << i)) for i in range(BITS)))
    free = F.filter(bits, lambda b: b.bitwiseAND(F.col("free")) != 0)
    places = F.concat(F.array("f"), F.transform(free, lambda b: F.col("f").bitwiseXOR(b)))
    met = (
        ignored.select("f", F.explode(places).alias("place"))
        .groupBy("place").agg(F.sort_array(F.collect_list("f")).alias("fs"))
        .where(F.size("fs") > 1)
    )
    edges = met.select(F.col("fs")[0].alias("a"), F.explode(F.slice("fs", 2, 65)).alias("b"))
    return edges.distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """One row per input row: ``id``, ``version`` (hash of the text), ``fingerprint`` and
    ``component_id``, the least id among the rows that links of two bits or fewer reach.

    Rows without words, nulls included, share fingerprint zero and are linked like any other.
    Repeated rows are in one component. A null id is no least id unless the component has no other.
    An empty table gives an empty result; columns besides id and text are not looked at.
    """
    spark = docs.sparkSession
    prints = stored(spark, docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"),
        fingerprint(F.col(text), size).alias("f"),
    ), "prints")
    roots = components(stored(spark, links(prints, "f"), "links"))
    first = prints.groupBy("f").agg(F.min("id").alias("id")).join(
        roots.withColumnRenamed("node", "f"), "f", "left"
    ).select("f", "id", F.coalesce("root", "f").alias("root"))
    first = stored(spark, first, "first")
    least = stored(spark, first.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    named = stored(spark, first.select("f", "root").join(least, "root").select("f", "component_id"), "named")
    return prints.join(named, "f").select(
        "id", "version", F.col("f").alias("fingerprint"), "component_id"
    )
