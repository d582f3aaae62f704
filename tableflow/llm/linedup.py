"""Line deduplication by pairwise alignment of overlapping documents."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.rows import keyed, stored
from tableflow.llm.text import SPACED, Words, chunks, lists, mix

ID = ("__id", "__version")


def lines(text: Column) -> Column:
    """Column: struct of the hashes of a text's lines and of their numbers of words.

    Lines end at a line feed. Two lines are equal if their words are: spaces around and between
    words don't count, and a line without words has hash zero.
    """

    @F.arrow_udf("struct<hashes:array<long>,words:array<int>>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            hashes, counts = [], []
            for rows, data, begins in chunks(texts):
                feeds = np.flatnonzero(data == 10)
                words = Words(rows, data, begins, SPACED)
                # A row's lines begin at its first byte and after each of its line feeds.
                starts = np.sort(np.concatenate([begins[:-1], feeds + 1]), kind="stable")
                ends = np.append(starts[1:], len(data))
                of_row = np.repeat(
                    np.arange(rows),
                    1 + np.searchsorted(feeds, begins[1:]) - np.searchsorted(feeds, begins[:-1]),
                )
                first, last = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
                sums = np.zeros(len(words.hashes) + 1, dtype=np.uint64)
                # The place in its line goes into each word's share, so their order counts.
                line_of = np.repeat(np.arange(len(starts)), last - first)
                nth = (np.arange(len(words.hashes)) - first[line_of]).astype(np.uint64)
                np.cumsum(mix(words.hashes + mix(nth + np.uint64(1))), out=sums[1:])
                h = sums[last] - sums[first]
                h[first == last] = 0
                at = np.searchsorted(of_row, np.arange(rows + 1))
                for r in range(rows):
                    hashes.append(h[at[r] : at[r + 1]].view(np.int64))
                    counts.append((last - first)[at[r] : at[r + 1]].astype(np.int32))
            yield pa.StructArray.from_arrays(
                [lists(hashes, pa.int64()), lists(counts, pa.int32())], ["hashes", "words"]
            )

    return split(text)


def patience(later: list[int], earlier: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences by patience diff.

    Common lines at both ends are aligned; between them, lines that occur once in either side are
    aligned along their longest increasing run, and the stretches between those in the same way.
    Without such lines a stretch's remaining lines are aligned only from its ends.
    """
    out: list[tuple[int, int]] = []
    work = [(0, len(later), 0, len(earlier))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and later[a] == earlier[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and later[b - 1] == earlier[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        left, right = Counter(later[a:b]), Counter(earlier[c:d])
        where = {h: c + j for j, h in enumerate(earlier[c:d]) if right[h] == 1 and left.get(h) == 1}
        once = [(a + i, where[h]) for i, h in enumerate(later[a:b]) if h in where and left[h] == 1]
        # Patience sorting: piles by top card, with a link to the pile on the left.
        tops: list[int] = []
        piles: list[tuple] = []
        for i, j in once:
            k = bisect_left(tops, j)
            node = (i, j, piles[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                piles.append(node)
            else:
                tops[k], piles[k] = j, node
        node, anchors = (piles[-1] if piles else None), []
        while node:
            anchors.append(node[:2])
            node = node[2]
        for i, j in anchors:  # from the last one to the first
            work.append((i, b, j, d))
            b, d = i, j
        if anchors:
            work.append((a, b, c, d))
    return sorted(out)


def _aligned_blocks(min_words: int):
    @F.arrow_udf("array<int>")
    def align(
        batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]],
    ) -> Iterator[pa.Array]:
        for later, words, earlier in batches:
            out = []
            for a, w, b in zip(later.to_pylist(), words.to_pylist(), earlier.to_pylist(), strict=True):
                # Lines without words neither align nor part a block.
                full = [i for i, h in enumerate(a) if w[i]]
                pairs = patience([a[i] for i in full], [h for h in b if h])
                gone: list[int] = []
                k = 0
                while k < len(pairs):
                    end = k + 1
                    while end < len(pairs) and pairs[end] == (pairs[end - 1][0] + 1, pairs[end - 1][1] + 1):
                        end += 1
                    block = [full[i] for i, _ in pairs[k:end]]
                    if sum(w[i] for i in block) >= min_words:
                        gone += block
                    k = end
                out.append(gone)
            yield lists(out, pa.int32())

    return align


def _links(min_words: int):
    """Column function of line hashes and numbers of words: the distinct hashes that link documents.

    From each line with words on, forwards and backwards, the shortest run of such lines that reaches
    ``min_words`` words: a long line alone, short ones together. So every line of a block that may be
    deleted lies in a run within the block. A long line counts with the next one as well, for a
    block's source may not be the first holder of its lines.
    """

    @F.arrow_udf("array<long>")
    def keys(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for hashes, words in batches:
            lengths = hashes.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lengths)), lengths)
            h = hashes.flatten().to_numpy().view(np.uint64)
            w = words.flatten().to_numpy().astype(np.int64)
            row, h, w = row[w > 0], h[w > 0], w[w > 0]
            sums = np.append(0, np.cumsum(w))
            # Behind the line with which a run from here on has enough words.
            ends = np.searchsorted(sums, sums[:-1] + max(min_words, 1))
            at = np.searchsorted(row, np.arange(len(lengths) + 1))
            nth = np.arange(len(row))
            ahead = np.flatnonzero(ends <= at[row + 1])
            # The last line from which a run up to here has enough words.
            starts = np.searchsorted(sums, sums[1:] - max(min_words, 1), side="right") - 1
            back = np.flatnonzero(starts >= at[row])
            both = np.flatnonzero((ends == nth + 1) & (nth + 2 <= at[row + 1]))
            start = np.concatenate([ahead, starts[back], both])
            end = np.concatenate([ends[ahead], back + 1, both + 2])
            order = np.argsort(start, kind="stable")
            start, end = start[order], end[order]
            found, of_row = _run_hashes(h, start, end), row[start]
            at = np.searchsorted(of_row, np.arange(len(lengths) + 1))
            yield lists(
                [np.unique(found[at[r] : at[r + 1]]).view(np.int64) for r in range(len(lengths))], pa.int64()
            )

    return keys


def _run_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs of lines from ``start`` to before ``end``."""
    out, longest = np.zeros(len(start), dtype=np.uint64), int((end - start).max(initial=0))
    for nth in range(longest):
        inside = start + nth < end
        out[inside] += mix(h[start[inside] + nth] + mix(np.array([nth + 1], dtype=np.uint64)))
    return out


def overlaps(split: DataFrame, min_words: int, rare: int | None = None) -> DataFrame:
    """Pairs (later document, earlier document) to align, ``__id`` and ``__version`` of each.

    Documents are found through shared keys (:func:`_links`), however many documents hold them; every
    block that may be deleted holds one. Of the documents that share a key, each is paired with the
    first only: as many pairs as occurrences, and every key that is repeated has its first holder
    among the pairs. ``rare`` is for
    links through rare lines only, see :func:`rare_overlaps`.
    """
    if rare is not None:
        return rare_overlaps(split, min_words, rare)
    keys = _links(min_words)("hashes", "words")
    return _first_holders(split.select(*ID, F.explode(keys).alias("h")))


def _first_holders(holders: DataFrame) -> DataFrame:
    """Pairs of each holder of a key (``h``) with the key's first one."""
    firsts = holders.groupBy("h").agg(F.min(F.struct(*ID)).alias("first"), F.max(F.struct(*ID)).alias("last"))
    # Stored, so that both sides of the join lie on shuffles of their own and a hot key can be split.
    firsts = stored(holders.sparkSession, firsts.where("first <> last").select("h", "first"), "firsts")
    pairs = holders.join(firsts, "h").select(*ID, "first")
    return pairs.where(F.struct(*ID) != F.col("first")).distinct()


def rare_overlaps(split: DataFrame, min_words: int, rare: int) -> DataFrame:
    """Like :func:`overlaps`, but through rare lines only: fewer pairs, and not all repeats are found.

    Links are lines of ``min_words`` words or more that occur in 2 to ``rare`` documents. More
    frequent ones count together with the next line, and if the document has no other line, alone,
    so groups of copies of any size are found.
    """
    one = split.where(F.size("hashes") > 0).select(
        *ID, F.posexplode(F.arrays_zip("hashes", "words")), F.col("hashes").alias("all")
    ).select(
        *ID, "pos", F.col("col.hashes").alias("h"), F.col("col.words").alias("w"),
        # The next line, or the end of the text; get() gives null beyond the end.
        F.xxhash64(F.col("col.hashes"), F.get("all", F.col("pos") + 1),
                   (F.col("pos") == F.size("all") - 1) & (F.col("pos") > 0)).alias("with_next"),
        ((F.col("pos") == F.size("all") - 1) & (F.col("pos") > 0)).alias("ending"),
    ).where(F.col("w") >= min_words).drop("pos", "w")
    holders = one.groupBy("h", *ID).agg(F.lit(1).alias("one"))
    common = holders.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct(*ID)).alias("first"))
    # Stored, so that both sides of the joins lie on shuffles of their own and a hot line can be split.
    spark = split.sparkSession
    common = stored(spark, common.where("n > 1"), "common")
    rare_keys = common.where(F.col("n") <= rare).select("h", "first")
    frequent = common.where(F.col("n") > rare).select("h")
    pairs = holders.join(rare_keys, "h").select(*ID, "first")
    longer = one.join(frequent, "h").where("not ending").select(*ID, F.col("with_next").alias("h"))
    firsts = longer.groupBy("h").agg(F.min(F.struct(*ID)).alias("first"), F.max(F.struct(*ID)).alias("last"))
    firsts = stored(spark, firsts.where("first <> last").select("h", "first"), "firsts")
    pairs = pairs.union(longer.join(firsts, "h").select(*ID, "first"))
    return pairs.where(F.struct(*ID) != F.col("first")).distinct()


def remove_repeated_blocks(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 5,
    rare: int | None = None,
) -> DataFrame:
    """The documents with aligned common blocks deleted from the later document of each pair.

    Pairs come from :func:`overlaps`. The line sequences of a pair are aligned with patience diff; a
    run of lines that is contiguous in both and has at least ``min_words`` words is deleted from
    the later document, the one with the greater (id, text hash), nulls last. Documents are compared as given, not as
    left by other pairs, so the first holder of a line keeps it and the result doesn't depend on the
    order of work. Added columns ``n_lines``, ``n_removed`` and ``removed`` (line numbers, from 0); an
    input column of such a name is replaced.

    Null texts stay null and empty ones empty. Repeated rows (equal id and text) are one document
    and get one result. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = keyed(docs, doc_id, text)
    split = docs.select(*ID, lines(F.col(text)).alias("l")).select(*ID, "l.*").dropDuplicates(ID)
    split = stored(spark, split, "lines")
    pairs = stored(spark, overlaps(split, min_words, rare), "pairs")
    earlier = split.select(F.struct(*ID).alias("first"), F.col("hashes").alias("earlier"))
    both = pairs.join(earlier, "first").drop("first").join(split, list(ID))
    gone = both.select(*ID, _aligned_blocks(min_words)("hashes", "words", "earlier").alias("gone"))
    gone = gone.where(F.size("gone") > 0).groupBy(*ID).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("__gone")
    )
    gone = stored(spark, gone, "gone")
    # The split text is used twice, so the optimizer keeps it a column and splits once.
    # Texts move once and aren't sorted; the plan is the same whatever the number of deletions.
    out = docs.join(gone.hint("shuffle_hash"), list(ID), "left").withColumns({
        "removed": F.coalesce("__gone", F.array().cast("array<int>")), "__parts": F.split(text, "\n"),
    })
    kept = F.array_except(F.sequence(F.lit(0), F.size("__parts") - 1), F.col("removed"))
    return out.withColumns({
        "n_lines": F.coalesce(F.size("__parts"), F.lit(0)).cast("long"),
        "n_removed": F.size("removed").cast("long"),
        text: F.when(
            F.size("removed") > 0, F.array_join(F.transform(kept, lambda i: F.get("__parts", i)), "\n")
        ).otherwise(F.col(text)),
    }).drop("__gone", "__parts", *ID)
