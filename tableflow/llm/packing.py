"""Best-fit packing of token sequences under conflicts."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.rows import stored

BINS = "bin long, slot int, doc_id long, part int, start long, n_tokens int, source string, cluster long"
REPEATS = 64  # of one item that are dealt to a shard together


class Bins:
    """Open bins in order of residual room, each with a bitmap of its sources and of its clusters.

    Bins of equal residual and equal bitmaps are interchangeable and lie on one stack, so the
    search passes over all bins with the same conflict in one step.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(capacity + 1)]
        self.filled = 0  # bit r is set while some bin has room r
        self.count = 0

    def place(self, size: int, source: int, cluster: int) -> int:
        """Put an item into the tightest bin without its bits, else into a new one; the bin."""
        rooms = self.filled >> size
        room = size
        while rooms:
            step = (rooms & -rooms).bit_length() - 1
            room += step
            for (sources, clusters), stack in self.by_room[room].items():
                if not (sources & source or clusters & cluster):
                    found = stack.pop()
                    if not stack:
                        del self.by_room[room][sources, clusters]
                        if not self.by_room[room]:
                            self.filled &= ~(1 << room)
                    return self._keep(found, room - size, sources | source, clusters | cluster)
            rooms >>= step + 1
            room += 1
        self.count += 1
        return self._keep(self.count - 1, self.capacity - size, source, cluster)

    def _keep(self, found: int, room: int, sources: int, clusters: int) -> int:
        if room:
            self.by_room[room].setdefault((sources, clusters), []).append(found)
            self.filled |= 1 << room
        return found


def pack(items: pa.Table, capacity: int) -> pa.Table:
    """The items of one shard with their bins and slots, largest first; ties by id, then part."""
    keys = [("n_tokens", "descending"), *((c, "ascending") for c in ("doc_id", "part", "source", "cluster"))]
    items = items.sort_by(keys)
    sizes, names, groups = (items[c].to_pylist() for c in ("n_tokens", "source", "cluster"))
    sources: dict = defaultdict(lambda: 1 << len(sources))
    often = Counter(groups)
    clusters: dict = defaultdict(lambda: 1 << len(clusters))
    bins, slots = Bins(capacity), Counter()
    placed, order = [], []
    for size, source, cluster in zip(sizes, names, groups, strict=True):
        # A missing source conflicts with nothing, nor does a cluster that has one item here.
        found = bins.place(
            size, 0 if source is None else sources[source],
            0 if often[cluster] == 1 else clusters[cluster],
        )
        placed.append(found)
        order.append(slots[found])
        slots[found] += 1
    return items.append_column("bin", pa.array(placed, pa.int64())).append_column(
        "slot", pa.array(order, pa.int32())
    )


def best_fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    capacity: int = 2048, shard_tokens: int = 1 << 21,
) -> DataFrame:
    """Training sequences: one row per document part with its ``bin`` and ``slot``.

    Tokens are words (runs without ASCII spaces). A document longer than ``capacity`` is cut into
    full parts and a rest; ``start`` is a part's first word. No bin holds two parts of one source or
    of one duplicate cluster (equal texts up to spaces), so parts of a document lie in different bins, too.
    Full parts have a bin of their own. The others are packed best-fit, largest first, into the
    bin with the least room that has none of the item's bits.

    Packing is sequential, so items are dealt by a hash to shards of about ``shard_tokens`` tokens,
    each packed by one task. Their number follows the input and a hot source or cluster is spread
    over all of them, as are repeated rows, by ``REPEATS``; conflicts are within a bin, so shards need
    not know of each other. Bins are numbered shard after shard. Shards depend on the items only, so a
    repeated run gives equal bins.

    Null and empty texts have no tokens and no row. A null source conflicts with nothing. Repeated
    rows are items like others, in different bins. Only id, text and source are looked at.
    """
    spark = docs.sparkSession
    trimmed = F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r"))
    words = F.split(trimmed, "[ \t-\r]+")
    items = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.when(trimmed != "", F.size(words)).otherwise(0).alias("words"),
        F.xxhash64(F.array_join(words, " ")).alias("cluster"),
    ).where("words > 0")
    items = items.select(
        "doc_id", "source", "cluster",
        F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("words").cast("long") - 1, F.lit(capacity).cast("long")))
        .alias("part", "start"), "words",
    ).withColumn("n_tokens", F.least(F.lit(capacity), F.col("words") - F.col("start")).cast("int"))
    items = items.drop("words")
    # Repeated items are one row with their number, so that they need no order to be dealt.
    items = stored(spark, items.groupBy(items.columns).agg(F.count("*").alias("repeats")), "items")
    total = items.agg(F.sum(F.col("n_tokens") * F.col("repeats"))).first()[0] or 0
    shards = -(-total // shard_tokens) or 1
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("repeats") - 1, F.lit(REPEATS).cast("long")))
    dealt = items.withColumn("first", first).withColumns({
        "repeats": F.least(F.lit(REPEATS), F.col("repeats") - F.col("first")),
        "shard": F.pmod(F.xxhash64("doc_id", "part", "n_tokens", "source", "cluster", "first"), F.lit(shards)),
    })

    def pack_shard(key: tuple, items: pa.Table) -> pa.Table:
        repeats = items["repeats"].to_numpy()
        found = pack(items.take(pa.array(np.repeat(np.arange(len(repeats)), repeats))), capacity)
        # Each shard numbers its bins in a range of its own.
        bins = pc.add(found["bin"], int(key[0].as_py()) << 32)
        found = found.set_column(found.schema.get_field_index("bin"), "bin", bins)
        return found.select([c.split()[0] for c in BINS.split(", ")])

    return dealt.groupBy("shard").applyInArrow(pack_shard, BINS)
