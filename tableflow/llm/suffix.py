"""Removal of repeated byte strings by sorting suffixes at sampled anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.losertree import decode, front_code, merge
from tableflow.llm.rows import keyed, stored
from tableflow.llm.text import chunks, mix, prefix_hashes, slices, span_hashes

GRAM = 32
HOT = 256  # regions of one gram in a batch beyond which its windows are dealt one by one
PART_BYTES = 64 << 20
BATCH_BYTES = 8 << 20  # of text whose runs a task sorts together
ID = ("__id", "__version")
# What a run of windows is to be: repeated as a whole, looked at by suffixes, or window by window.
REPEATED, SORTED, DEALT = range(3)
_LOW = np.uint64(0xFFFFFFFF)


def anchored_runs(data: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows of ``length`` bytes with one anchor: (hash of the gram at the anchor, hash of
    the run's bytes and of the anchor's place, row, start in the row, number of windows, anchor's place in the run).

    The anchor of a window is the least by hash of its grams, the last one among equals, so it
    depends on the window's bytes alone, and equal windows have the same gram at the same place.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    sums = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = span_hashes(sums, at, at + GRAM)
    width = length - GRAM + 1
    # Hash above, place below, reversed so that the last of equal grams is the least.
    order = (grams & ~_LOW) | (_LOW - at.astype(np.uint64))
    padded = np.concatenate([order, np.full(-len(order) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(order) - width + 1
    anchors = (_LOW - (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & _LOW)).astype(np.int64)
    row = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    starts = np.flatnonzero(row[:n] == row[length - 1 : length - 1 + n])
    if not len(starts):
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    anchors = anchors[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (row[starts[1:]] != row[starts[:-1]])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(starts)))
    begin, anchor = starts[first], anchors[first]
    region = span_hashes(sums, begin, begin + counts - 1 + length) ^ mix((anchor - begin).astype(np.uint64))
    row = row[begin]
    return grams[anchor], region, row, begin - begins[row], counts, anchor - begin


def _code(start: np.ndarray, count: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
    return (start.astype(np.int64) << 12) | (count.astype(np.int64) << 2) | kind


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in some column."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


# ---- first pass: runs that are equal as a whole -----------------------------------------------

_RUNS = ("part int, gram binary, region binary, hot binary, doc binary, code binary, ids binary, versions binary, "
         "known_doc binary, known binary, known_ids binary, known_versions binary")
_FOUND = "__id long, __version long, code long"


def _buffers(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array([a.tobytes()], pa.binary()) for a in arrays]


def _collect_runs(length: int, parts: int, most: int):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            ids = batch.column("__id").to_numpy()
            versions = batch.column("__version").to_numpy()
            # Rows that repeat id and text are one document.
            same = np.lexsort((versions, ids))
            rank = np.empty(len(ids), dtype=np.int64)
            rank[same] = np.cumsum(_firsts(ids[same], versions[same]))
            extra = np.ones(len(ids), dtype=bool)
            extra[same[_firsts(ids[same], versions[same])]] = False
            pieces, base = [], 0
            for rows, data, begins in chunks(batch.column("text")):
                gram, region, row, start, count, _ = anchored_runs(data, begins, length)
                pieces.append((gram, region, row + base, start, count))
                base += rows
            if not pieces:
                continue
            gram, region, doc, start, count = (np.concatenate(c) for c in zip(*pieces, strict=True))
            keep = ~extra[doc]
            gram, region, doc, start, count = (c[keep] for c in (gram, region, doc, start, count))
            order = np.lexsort((start, rank[doc], region, gram))
            gram, region, doc, start, count = (c[order] for c in (gram, region, doc, start, count))
            first = _firsts(gram, region)
            code = _code(start, count, REPEATED)
            known_doc, known = [doc[~first]], [code[~first]]
            gram, region, doc, code = gram[first], region[first], doc[first], code[first]
            # Of a gram with very many regions one goes where the gram is dealt, marked as hot.
            heads = np.flatnonzero(_firsts(gram))
            sizes = np.diff(np.append(heads, len(gram)))
            hot = np.repeat(sizes > most, sizes)
            known_doc.append(doc[hot])
            known.append(code[hot] | DEALT)
            send = ~hot
            send[heads] = True
            gram, region, doc, code, hot = (c[send] for c in (gram, region, doc, code, hot))
            known_doc, known = np.concatenate(known_doc), np.concatenate(known)
            part = (gram >> np.uint64(33)) % np.uint64(parts)
            known_part = known_doc % parts
            by_part = np.argsort(part, kind="stable")
            known_by_part = np.argsort(known_part, kind="stable")
            cuts = np.searchsorted(part[by_part], np.arange(parts + 1, dtype=np.uint64))
            known_cuts = np.searchsorted(known_part[known_by_part], np.arange(parts + 1))
            for p in range(parts):
                take = by_part[cuts[p] : cuts[p + 1]]
                taken = known_by_part[known_cuts[p] : known_cuts[p + 1]]
                if not len(take) and not len(taken):
                    continue
                docs, place = np.unique(doc[take], return_inverse=True)
                known_docs, known_place = np.unique(known_doc[taken], return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), *_buffers(
                        gram[take], region[take], hot[take], place.astype(np.uint32), code[take],
                        ids[docs], versions[docs],
                        known_place.astype(np.uint32), known[taken], ids[known_docs], versions[known_docs],
                    )],
                    [c.split()[0] for c in _RUNS.split(", ")],
                )

    return collect


def _array(batch: pa.RecordBatch, name: str, i: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_buffer(), dtype=kind)


def _found(ids: np.ndarray, versions: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(versions), pa.array(code)], [c.split()[0] for c in _FOUND.split(", ")]
    )


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one part's runs: those equal to an earlier one, and of those that share only the gram with
    another, one for each content."""
    pieces = []
    for batch in batches:
        for i in range(batch.num_rows):
            place = _array(batch, "known_doc", i, np.uint32)
            if len(place):
                yield _found(_array(batch, "known_ids", i, np.int64)[place],
                             _array(batch, "known_versions", i, np.int64)[place], _array(batch, "known", i, np.int64))
            doc = _array(batch, "doc", i, np.uint32)
            pieces.append((
                _array(batch, "gram", i, np.uint64), _array(batch, "region", i, np.uint64),
                _array(batch, "hot", i, bool), _array(batch, "ids", i, np.int64)[doc],
                _array(batch, "versions", i, np.int64)[doc], _array(batch, "code", i, np.int64),
            ))
    gram, region, hot, ids, versions, code = (np.concatenate(c) for c in zip(*pieces, strict=True))
    # Most grams occur once; the rest is sorted by content and position.
    _, place, counts = np.unique(gram, return_inverse=True, return_counts=True)
    often = (counts[place] > 1) | hot
    gram, region, hot, ids, versions, code = (c[often] for c in (gram, region, hot, ids, versions, code))
    order = np.lexsort((code, versions, ids, region, gram))
    gram, region, hot, ids, versions, code = (c[order] for c in (gram, region, hot, ids, versions, code))
    first = _firsts(gram, region)
    head = np.flatnonzero(first)
    lead = head[np.cumsum(first) - 1]  # the first run of equal content
    again = ~first & ((ids != ids[lead]) | (versions != versions[lead]) | (code != code[lead]))
    yield _found(ids[again], versions[again], code[again])
    new = _firsts(gram)
    group = np.cumsum(new) - 1
    regions = np.bincount(group, weights=first)
    is_hot = np.bincount(group, weights=hot) > 0
    rest = first & ~hot & ((regions[group] > 1) | is_hot[group])
    kind = np.where(is_hot[group], DEALT, SORTED)
    yield _found(ids[rest], versions[rest], code[rest] | kind[rest])


# ---- second pass: windows that are equal ------------------------------------------------------

_SUFFIXES = ("part int, dealt boolean, shared binary, lengths binary, rests binary, lefts binary, before binary, "
             "hash binary, doc binary, start binary, ids binary, versions binary")


def _cut_regions(column: str, length: int, parts: int):
    """Of a batch of documents with codes: for every part, the suffixes from the anchors of the runs to
    compare, sorted and front-coded, with the bytes before them; or hashes of single windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, column, BATCH_BYTES)):
            ids = batch.column("__id").to_numpy()
            versions = batch.column("__version").to_numpy()
            suffixes: list[tuple[int, bytes, bytes, int, int]] = []
            dealt: list[tuple[np.ndarray, ...]] = []
            done = set()
            for row, codes in enumerate(batch.column("__codes")):
                code = np.array(codes.as_py() or (), dtype=np.int64)
                code = code[(code & 3) != REPEATED]
                if not len(code) or (ids[row], versions[row]) in done:
                    continue
                done.add((ids[row], versions[row]))
                text = batch.column(column)[row].as_buffer()
                data = np.frombuffer(text, dtype=np.uint8)
                sums = None
                for c in code.tolist():
                    start, count = c >> 12, c >> 2 & 1023
                    piece = data[start : start + count - 1 + length]
                    if c & 3 == DEALT:
                        sums = prefix_hashes(data) if sums is None else sums
                        at = np.arange(start, start + count)
                        dealt.append((span_hashes(sums, at, at + length), np.full(count, row), at))
                    else:
                        suffixes.append((row, start, piece.tobytes()))
            yield from _sorted_suffixes(suffixes, ids, versions, length, parts)
            if dealt:
                hashes, doc, start = (np.concatenate(c) for c in zip(*dealt, strict=True))
                yield from _dealt_windows(hashes, doc, start, ids, versions, parts)

    return cut


def _columns(part: int, dealt: bool, **values) -> pa.RecordBatch:
    names = [c.split()[0] for c in _SUFFIXES.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([dealt]),
         *(pa.array([values.get(n, b"")], pa.binary()) for n in names[2:])], names,
    )


def _sorted_suffixes(regions, ids, versions, length, parts):
    """The regions' anchors are found again from their bytes, all at once."""
    if not regions:
        return
    joined = np.frombuffer(b"".join(r[2] for r in regions), dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(r[2]) for r in regions])])
    gram, _, row, start, count, anchor = anchored_runs(joined, begins, length)
    assert len(row) == len(regions) and not start.any(), "a run has one anchor"
    part = ((gram >> np.uint64(33)) % np.uint64(parts)).tolist()
    anchor = anchor.tolist()
    by_part: dict[int, list] = {}
    for i, (doc, begin, piece) in enumerate(regions):
        by_part.setdefault(part[i], []).append((piece[anchor[i]:], piece[: anchor[i]], doc, begin))
    for p, entries in by_part.items():
        entries.sort()
        shared, lengths, rests = front_code([e[0] for e in entries])
        docs, place = np.unique([e[2] for e in entries], return_inverse=True)
        yield _columns(
            p, False, shared=shared.tobytes(), lengths=lengths.tobytes(), rests=rests,
            lefts=b"".join(e[1] for e in entries),
            before=np.array([len(e[1]) for e in entries], dtype=np.uint16).tobytes(),
            doc=place.astype(np.uint32).tobytes(),
            start=np.array([e[3] for e in entries], dtype=np.int64).tobytes(),
            ids=ids[docs].tobytes(), versions=versions[docs].tobytes(),
        )


def _dealt_windows(hashes, doc, start, ids, versions, parts):
    """For each window content of the batch its first position; what repeats one is marked by a start
    below zero and needs no comparison."""
    order = np.lexsort((start, versions[doc], ids[doc], hashes))
    hashes, doc, start = hashes[order], doc[order], start[order]
    start = np.where(_firsts(hashes), start, ~start)
    part = (hashes >> np.uint64(33)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    for p in range(parts):
        take = order[cuts[p] : cuts[p + 1]]
        if len(take):
            docs, place = np.unique(doc[take], return_inverse=True)
            yield _columns(
                p, True, hash=hashes[take].tobytes(), doc=place.astype(np.uint32).tobytes(),
                start=start[take].astype(np.int64).tobytes(),
                ids=ids[docs].tobytes(), versions=versions[docs].tobytes(),
            )


def _repeats(hashes, ids, versions, start) -> pa.RecordBatch:
    """Windows that are not the first of their content."""
    order = np.lexsort((start, versions, ids, hashes))
    hashes, ids, versions, start = (c[order] for c in (hashes, ids, versions, start))
    first = _firsts(hashes)
    lead = np.flatnonzero(first)[np.cumsum(first) - 1] if len(first) else np.zeros(0, dtype=np.int64)
    again = ~first & ((ids != ids[lead]) | (versions != versions[lead]) | (start != start[lead]))
    return _as_runs(ids[again], versions[again], start[again])


def _as_runs(ids, versions, start) -> pa.RecordBatch:
    """Windows that follow one another, as codes of runs."""
    order = np.lexsort((start, versions, ids))
    ids, versions, start = ids[order], versions[order], start[order]
    new = _firsts(ids, versions, start - np.arange(len(start)))
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(start)))
    # A code holds up to 1023 windows; runs here come from regions of fewer, but may touch.
    while len(counts) and counts.max() > 1000:
        long = counts > 1000
        first = np.concatenate([first, first[long] + 1000])
        counts = np.concatenate([np.minimum(counts, 1000), counts[long] - 1000])
    return _found(ids[first], versions[first], _code(start[first], counts, REPEATED))


def _compare_suffixes(length: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, extras, dealt = [], [], []
        for batch in batches:
            for i in range(batch.num_rows):
                doc = _array(batch, "doc", i, np.uint32)
                ids = _array(batch, "ids", i, np.int64)[doc]
                versions = _array(batch, "versions", i, np.int64)[doc]
                start = _array(batch, "start", i, np.int64)
                if batch.column("dealt")[i].as_py():
                    hashes = _array(batch, "hash", i, np.uint64)
                    again = start < 0
                    yield _as_runs(ids[again], versions[again], ~start[again])
                    dealt.append((hashes[~again], ids[~again], versions[~again], start[~again]))
                    continue
                before = _array(batch, "before", i, np.uint16).tolist()
                lefts, at, cut = batch.column("lefts")[i].as_py(), 0, []
                for n in before:
                    cut.append(lefts[at : at + n])
                    at += n
                runs.append(decode(_array(batch, "shared", i, np.uint16), _array(batch, "lengths", i, np.uint16),
                                   batch.column("rests")[i].as_py()))
                extras.append(iter(zip(cut, ids.tolist(), versions.tolist(), start.tolist(), strict=True)))
        if dealt:
            yield _repeats(*(np.concatenate(c) for c in zip(*dealt, strict=True)))
        held: list[tuple] = []  # neighbours that share a gram
        windows: list[tuple] = []
        size = 0
        for shared, suffix, run in merge(runs):
            left, id_, version, start = next(extras[run])
            if shared < GRAM:
                windows += _reaching(held, length)
                held = []
                if len(windows) > 20_000:
                    yield _hashed_repeats(windows, length)
                    windows = []
            held.append((shared, suffix, left, id_, version, start))
            size += 1
        windows += _reaching(held, length)
        if windows:
            yield _hashed_repeats(windows, length)

    return compare


def _reaching(held: list[tuple], length: int) -> list[tuple]:
    """Of suffixes with a common gram: (bytes, id, version, start, first window to look at). A suffix agrees
    with no other beyond what it shares with its neighbours, so windows that would need more are left out."""
    out = []
    for i, (shared, suffix, left, id_, version, start) in enumerate(held):
        most = max(shared if i else 0, held[i + 1][0] if i + 1 < len(held) else 0)
        # A window that begins ``k`` bytes into the region needs length - (len(left) - k) bytes of the suffix.
        last = min(len(left), most + len(left) - length, len(left) + len(suffix) - length)
        if last >= 0 and len(held) > 1:
            out.append((left + suffix, id_, version, start, last + 1))
    return out


def _hashed_repeats(windows: list[tuple], length: int) -> pa.RecordBatch:
    data = np.frombuffer(b"".join(w[0] for w in windows), dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(w[0]) for w in windows])[:-1]])
    counts = np.array([w[4] for w in windows])
    row = np.repeat(np.arange(len(windows)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[row] + place
    hashes = span_hashes(prefix_hashes(data), at, at + length)
    ids, versions, start = (np.array([w[k] for w in windows], dtype=np.int64)[row] for k in (1, 2, 3))
    return _repeats(hashes, ids, versions, start + place)


# ---- the operator ------------------------------------------------------------------------------

def _union(code: np.ndarray, length: int) -> list[int]:
    """Edges of the bytes that runs of repeated windows cover: from, to, from, to, ..."""
    code = np.sort(code[(code & 3) == REPEATED])
    if not len(code):
        return []
    start = code >> 12
    end = np.maximum.accumulate(start + (code >> 2 & 1023) - 1 + length)
    new = np.ones(len(code), dtype=bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(code)) - 1
    return np.column_stack([start[first], end[last]]).ravel().tolist()


def _cut_out(length: int):
    """Spans and what is left of a text, in one pass over it."""

    @F.arrow_udf("struct<spans:array<long>,kept:binary>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, whole, single in batches:
            spans, kept = [], []
            for text, a, b in zip(texts, whole, single, strict=True):
                code = np.array((a.as_py() or []) + (b.as_py() or []), dtype=np.int64)
                edges = _union(code, length)
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                if edges:
                    cuts = [0, *edges, len(data)]
                    data = b"".join(data[x:y] for x, y in zip(cuts[::2], cuts[1::2], strict=True))
                spans.append(edges)
                kept.append(data)
            yield pa.StructArray.from_arrays(
                [pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())], ["spans", "kept"]
            )

    return cut


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100, hot: int = HOT
) -> DataFrame:
    """The rows of ``docs`` with ``spans``, the bytes of the text (from, to, from, to, ...) that are
    covered by a string of ``length`` bytes which also starts earlier, that is in a document with a
    smaller id, or before in the same one; and with ``kept``, the other bytes. Strings don't cross
    documents and may overlap; all are judged on the input.

    1. Windows of ``length`` bytes are grouped by anchors (:func:`anchored_runs`). A run of windows
       goes, as two hashes, to where its gram is dealt. Runs equal to an earlier one are repeated as
       a whole; those that share only the gram with another are compared further, each content once.
    2. For those, the suffixes from the anchors are sorted within each task, front-coded, and exchanged by
       their gram. A loser tree merges the runs, and the prefixes it finds tell which windows may agree with
       another suffix; these are compared with their left sides by a 64-bit hash.
    3. The documents meet the marked runs.

    Suffixes that share no gram with another can't hold a repeated string, so they aren't sorted. A
    gram with very many contents is hot: its runs are not gathered where the gram is dealt, but
    dealt window by window, each content once a task. Nothing is left out, and no task gets more of a gram than
    a few hundred rows from each batch.

    Null texts are empty. Rows equal in id and text are one document. Rows that share an id but not
    the text are ordered by a hash of it; a null id comes last. Input columns ``spans`` and
    ``kept`` are replaced, others stay.
    """
    if not GRAM < length <= 900:
        raise ValueError(f"a length above {GRAM} and up to 900 bytes")
    spark = docs.sparkSession
    docs = keyed(docs, doc_id, text)
    texts = docs.select(*ID, F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(total // PART_BYTES, 8 * spark.sparkContext.defaultParallelism)
    runs = texts.mapInArrow(_collect_runs(length, parts, hot), _RUNS)
    found = runs.groupBy("part").applyInArrow(_iterated(_compare_runs), _FOUND)
    codes = stored(spark, found, "runs").groupBy(*ID).agg(F.collect_list("code").alias("__codes"))
    # Both uses have all columns, so that one exchange of the texts serves the cut and the result.
    joined = docs.join(codes.hint("shuffle_hash"), list(ID), "left")
    cut = joined.mapInArrow(_cut_regions(text, length, parts), _SUFFIXES)
    single = cut.groupBy("part").applyInArrow(_iterated(_compare_suffixes(length)), _FOUND)
    single = single.groupBy(*ID).agg(F.collect_list("code").alias("__single"))
    out = joined.join(single.hint("shuffle_hash"), list(ID), "left")
    out = out.withColumn("__cut", _cut_out(length)(F.col(text), F.col("__codes"), F.col("__single")))
    out = out.withColumns({"spans": F.col("__cut.spans"), "kept": F.col("__cut.kept")})
    return out.drop("__cut", "__codes", "__single", *ID)


def _iterated(compare):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from compare(batches)

    return run
