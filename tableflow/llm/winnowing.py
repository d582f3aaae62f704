"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.text import ALPHANUMERIC, Words, chunks, lists
from tableflow.session import scratch_dir

GRAM = 5
RESULT = "n_words long, n_hit long, items array<long>, spans array<long>"


def winnow(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the least gram of every window of words, ties all included.

    Two texts that share ``window`` words share the grams within, so the least one of them is
    picked in both, at the same place of the span.
    """
    grams, _ = words.grams(GRAM)
    n = len(words.row) - window + 1
    picked = np.zeros(len(grams), dtype=bool)
    if n > 0:
        whole = words.row[:n] == words.row[window - 1 :]
        width = window - GRAM + 1
        least = grams[:n].copy()
        for j in range(1, width):
            np.minimum(least, grams[j : j + n], out=least)
        for j in range(width):
            picked[j : j + n] |= whole & (grams[j : j + n] == least)
    at = np.flatnonzero(picked)
    return at, grams[at]


class ItemIndex:
    """Fingerprints of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.window, self.ids = window, [i for i, _ in items]
        self.words: list[list[bytes]] = []
        postings: dict[int, list] = defaultdict(list)
        short: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        base = 0
        for rows, data, begins in chunks(pa.array([t for _, t in items], pa.string())):
            words = Words(rows, data, begins, ALPHANUMERIC)
            for r in range(rows):
                self.words.append([words.word(i) for i in range(*words.bounds[r : r + 2])])
            for at, key in zip(*winnow(words, window), strict=True):
                r = words.row[at]
                postings[int(key)].append((base + int(r), int(at - words.bounds[r])))
            for size in set(words.counts[(words.counts > 0) & (words.counts < window)].tolist()):
                keys, _ = words.grams(size)
                for r in np.flatnonzero(words.counts == size):
                    short[size][int(keys[words.bounds[r]])].append((base + int(r), 0))
            base += rows
        self.long = _sorted(postings)
        self.short = {size: _sorted(found) for size, found in short.items()}

    def seeds(self, words: Words) -> list[tuple[int, int, int]]:
        """(word of the chunk, item, word of the item) where fingerprints agree."""
        out = []
        lookups = [(self.long, *winnow(words, self.window))] if len(self.long[0]) else []
        for size, table in self.short.items():
            grams, whole = words.grams(size)
            at = np.flatnonzero(whole)
            lookups.append((table, at, grams[at]))
        for (keys, postings), at, grams in lookups:
            place = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            hit = np.flatnonzero(keys[place] == grams)
            out += [(int(at[h]), item, j) for h in hit for item, j in postings[place[h]]]
        return out

    def extend(self, words: Words) -> dict[int, list[tuple[int, int, int]]]:
        """Per row, (item, from, to): the longest agreement around each seed, compared word by word
        and kept where it holds a window of the item."""
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        reach: dict[tuple[int, int], int] = {}
        for i, item, j in sorted(self.seeds(words)):
            if reach.get((item, i - j), 0) > i:
                continue  # within a span found before
            r = int(words.row[i])
            low, high = int(words.bounds[r]), int(words.bounds[r + 1])
            other = self.words[item]
            a, b = i, j
            while a > low and b > 0 and words.word(a - 1) == other[b - 1]:
                a, b = a - 1, b - 1
            c, d = i, j
            while c < high and d < len(other) and words.word(c) == other[d]:
                c, d = c + 1, d + 1
            if c - a >= min(self.window, len(other)):
                reach[item, i - j] = c
                found[r].append((item, a - low, c - low))
        return found


def _sorted(postings: dict[int, list]) -> tuple[np.ndarray, list]:
    keys = sorted(postings)
    return np.array(keys, dtype=np.uint64), [postings[k] for k in keys]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _marker(shared):
    @F.arrow_udf(f"struct<{RESULT.replace(' ', ':').replace(',:', ',')}>")
    def mark(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index: ItemIndex = shared.value
        for texts, items_before, spans_before in batches:
            n_words, n_hit, items, spans = [], [], [], []
            base = 0
            for rows, data, begins in chunks(texts):
                words = Words(rows, data, begins, ALPHANUMERIC)
                n_words += words.counts.tolist()
                found = index.extend(words)
                for r in range(rows):
                    here = found.get(r, [])
                    ids = set(items_before[base + r].as_py() or []) | {index.ids[i] for i, _, _ in here}
                    flat = spans_before[base + r].as_py() or []
                    both = merged([*zip(flat[::2], flat[1::2]), *((a, b) for _, a, b in here)])
                    items.append(sorted(ids))
                    spans.append([x for s in both for x in s])
                    n_hit.append(sum(b - a for a, b in both))
                base += rows
            yield pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 lists(items, pa.int64()), lists(spans, pa.int64())],
                ["n_words", "n_hit", "items", "spans"],
            )

    return mark


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The items in blocks by hash, none above ``block_bytes`` unless one item alone is larger."""
    items = benchmark.select(
        F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")
    ).where("id is not null and text is not null").distinct()
    n = 1
    while True:
        block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
        most = (
            items.groupBy(block).agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n"))
            .where("n > 1").agg(F.max("b")).first()[0]
        ) or 0
        if most <= block_bytes:
            return [items.where(block == i) for i in range(n)]
        n *= 2


def mark_overlap(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", out: str = "overlap", window: int = 10, block_bytes: int = 32 << 20,
) -> DataFrame:
    """The documents with a struct ``out``: their number of words, of words within an occurrence of
    an item's window, the items with such windows, and the spans of words (from, to, from, to, ...).

    Words are runs of letters, digits and non-ASCII characters with A-Z lowered. An item's windows
    are its runs of ``window`` words; a shorter item is one window. Every shared run of ``window``
    words is found: the least of its grams of five words is kept by both sides. Items below
    ``window`` words give no such guarantee and are looked up by all of their words at once.

    The items are the query set: they come in blocks of bounded size, each indexed and broadcast,
    and a block meets all documents without moving them. Between blocks the documents are stored,
    so one index is in memory at a time. Nothing is capped, so results don't depend on the blocks.

    Rows are kept as they are: a null text has no words, repeated rows get equal results, and an
    input column named like ``out`` is replaced. Items with a null id or text are ignored, ids that
    repeat count once. Without items no word is hit.
    """
    spark = docs.sparkSession
    if window <= GRAM:
        raise ValueError(f"a window has more than {GRAM} words")
    docs = docs.withColumn(out, F.lit(None).cast(f"struct<{RESULT}>"))
    blocks = item_blocks(benchmark, item_id, item_text, block_bytes)
    for k, block in enumerate(blocks):
        index = ItemIndex([(r.id, r.text) for r in block.collect()], window)
        mark = _marker(spark.sparkContext.broadcast(index))
        docs = docs.withColumn(out, mark(F.col(text), F.col(f"{out}.items"), F.col(f"{out}.spans")))
        if k + 1 < len(blocks):
            folder = scratch_dir(spark, "overlap")
            docs.write.parquet(folder)
            docs = spark.read.schema(docs.schema).parquet(folder)
    return docs


def overlap_counts(marked: DataFrame, out: str = "overlap") -> list:
    """Columns of the counts and of the digest of the item ids sorted as text."""
    ids = F.array_join(F.array_sort(F.transform(f"{out}.items", lambda i: i.cast("string"))), ",")
    return [
        F.col(f"{out}.n_words").alias("n_words"),
        F.col(f"{out}.n_hit").alias("n_hit"),
        F.size(f"{out}.items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.col(f"{out}.n_hit") > 0).alias("contaminated"),
    ]
