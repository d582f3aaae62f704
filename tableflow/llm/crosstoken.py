"""Alignment of two tokenizations of the same bytes, and how often their tokens are linked."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.text import slices

BATCH_BYTES = 1 << 19
LANE = 2048
PIECE = 1 << 19
KNOWN = 120_000
SPACE = "▁"
# Fixed value: how byte-level BPE of this kind splits texts before it merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A space behind a character that isn't white space: both tokenizers begin a token there.
_CUT = re.compile(r"(?<=\S) (?=.)", re.DOTALL)


class Vocabulary(NamedTuple):
    """Where the tokenizers' files are: byte-level BPE (A) and pieces with byte fallback (B)."""

    a: str
    b: str


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others for the characters from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _byte_tokens(path: str) -> tuple[list[bytes], set[int]]:
    """The bytes of each token of a byte-level BPE file, and the ids of its special tokens."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["id"] for t in model["added_tokens"]}
    vocabulary, alphabet = model["model"]["vocab"], byte_alphabet()
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["model"]["merges"]]
    if merged != sorted(set(merged)):
        raise ValueError(f"the ids of {path} aren't in the order of its merges")
    out = [b""] * (max([*vocabulary.values(), *special]) + 1)
    for token, i in vocabulary.items():
        if i not in special:
            out[i] = bytes(alphabet[c] for c in token)
    return out, special


class Encoder:
    """Both tokenizers. ``bytes_a`` and ``bytes_b`` are the tokens' bytes; control tokens have none."""

    def __init__(self, files: Vocabulary):
        import sentencepiece
        import tiktoken

        self.b = sentencepiece.SentencePieceProcessor(model_file=files.b)
        self.bytes_a, special = _byte_tokens(files.a)
        # The same vocabulary in the faster engine: ids ascend in the order of merges.
        ranks = {token: i for i, token in enumerate(self.bytes_a) if token and i not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                self.bytes_b.append(b"")
            else:
                self.bytes_b.append(piece.replace(SPACE, " ").encode())
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # A piece with a space behind another character would reach over a cut.
        # Each id as text with the sign behind it: within a group, at the end of A's part, and of B's.
        self.signs = [
            f"{i}{sign}" for tokens, signs in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for sign in signs for i in range(len(tokens))
        ]
        self.known: dict[str, tuple | None] = {}
        self.cuts = not any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(len(self.bytes_b)))

    def pairs(self) -> np.ndarray:
        """All pairs of ids that can ever be linked, ascending: tokens that end together are each
        other's suffix, so the pairs number at most the bytes of both vocabularies, by equal tokens."""
        by_bytes: tuple[dict, dict] = ({}, {})
        for ids, tokens in zip(by_bytes, (self.bytes_a, self.bytes_b), strict=True):
            for i, token in enumerate(tokens):
                ids.setdefault(token, []).append(i)
        n = len(self.bytes_b)
        found = {
            a * n + b
            for a, token in enumerate(self.bytes_a) for k in range(len(token)) for b in by_bytes[1].get(token[k:], ())
        } | {
            a * n + b
            for b, token in enumerate(self.bytes_b) for k in range(len(token)) for a in by_bytes[0].get(token[k:], ())
        }
        return np.array(sorted(found), dtype=np.int64)

    def _encoded(self, words: list[str]) -> Iterator[tuple[bytes, bytes] | None]:
        """The ids of a space and each word in both vocabularies, as arrays' bytes, or nothing where the
        pieces of B aren't its bytes; A has a token for every byte."""
        bytes_b, encode_a = self.bytes_b.__getitem__, self.a.encode_ordinary
        for word, ids in zip(words, self.b.encode(words, num_threads=1), strict=True):
            whole = " " + word
            if b"".join(map(bytes_b, ids)) == whole.encode():
                yield array("i", encode_a(whole)).tobytes(), array("i", ids).tobytes()
            else:
                yield None

    def words(self, text: str) -> list[str]:
        """A text cut where both tokenizers begin a token whatever stands around; each part comes with a
        space in front, the first by the added one."""
        return _CUT.split(text) if self.cuts else [text]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text in both vocabularies; empty where a text has none or can't be given back.

        Words that were seen are remembered, up to ``KNOWN`` short ones."""
        parts: list[list[list[tuple]]] = [[] for _ in texts]
        wrong = set()
        for group in _grouped(texts, self.cuts):
            split = [(i, self.words(piece)) for i, piece in group]
            new = [w for w in {w for _, words in split for w in words} if w not in self.known]
            found = dict(zip(new, self._encoded(new), strict=True))
            for i, words in split:
                ids = [found[w] if w in found else self.known[w] for w in words]
                if None in ids:
                    wrong.add(i)
                else:
                    parts[i].append([np.frombuffer(b"".join(map(itemgetter(k), ids)), dtype=np.int32) for k in (0, 1)])
            if len(self.known) + len(found) > KNOWN:
                self.known.clear()
            self.known.update((w, ids) for w, ids in found.items() if len(w) <= 64)
        nothing = np.zeros(0, dtype=np.int32)
        return tuple(
            [np.concatenate([p[k] for p in own]) if own and i not in wrong else nothing for i, own in enumerate(parts)]
            for k in (0, 1)
        )


def _grouped(texts: list[str], cuts: bool) -> Iterator[list[tuple[int, str]]]:
    """Texts in groups of about ``PIECE`` characters; a longer one in pieces, cut where words are."""
    group, held = [], 0
    for i, text in enumerate(texts):
        begin = 0
        while begin < len(text):
            cut = _CUT.search(text, begin + PIECE) if cuts and len(text) - begin > PIECE else None
            piece = text[begin : cut.start() if cut else len(text)]
            group.append((i, piece))
            held += len(piece)
            begin = cut.end() if cut else len(text)
            if held >= PIECE:
                yield group
                group, held = [], 0
    if group:
        yield group


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, lanes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of A and of B that end together, by their places, in ascending order.

    ``ends`` are the end offsets of all tokens of a batch, each text's bytes behind those of the
    texts before. A lane (first and last-but-one token of A, the same of B) is a stretch of one text
    where A and B begin and end together. One step moves every lane on: the token that ends first is
    passed, or both where they end together, which is a link and a cut. Finished lanes are taken out.
    """
    at_a, stop, at_b, _ = lanes.T.copy()
    links_a, links_b = [], []
    open_ = at_a < stop
    at_a, stop, at_b = at_a[open_], stop[open_], at_b[open_]
    while len(at_a):
        a, b = ends_a[at_a], ends_b[at_b]
        meet = a == b
        links_a.append(at_a[meet])
        links_b.append(at_b[meet])
        at_a = at_a + (a <= b)
        at_b = at_b + (b <= a)
        # The last tokens of A and B end together, so a lane is finished with the last of A.
        if (done := at_a == stop).any():
            at_a, stop, at_b = at_a[~done], stop[~done], at_b[~done]
    if not links_a:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    links_a, links_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(links_a, kind="stable")
    return links_a[order], links_b[order]


def _lanes(texts: list[str], ends_a: np.ndarray, ends_b: np.ndarray, counts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Texts as lanes; a long one is several, cut at spaces where both tokenizations end a token."""
    last = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
    out = []
    for i, text in enumerate(texts):
        (a, a_end), (b, b_end) = ((x[i], x[i + 1]) for x in last)
        if a == a_end:
            continue
        begin = int(ends_a[a - 1]) if a else 0
        if ends_a[a_end - 1] - begin > 2 * LANE:
            whole = np.frombuffer(text.encode(), dtype=np.uint8)
            spaces = np.flatnonzero(whole == 32) + 1 + begin  # in front of it stands the added space
            near = np.searchsorted(spaces, np.arange(begin + LANE, begin + len(whole), LANE))
            cuts = np.unique(spaces[near[near < len(spaces)]])
            in_a = np.searchsorted(ends_a[a:a_end], cuts) + a
            in_b = np.searchsorted(ends_b[b:b_end], cuts) + b
            both = (ends_a[in_a] == cuts) & (ends_b[in_b] == cuts) & (in_a + 1 < a_end)
            for x, y in zip((in_a[both] + 1).tolist(), (in_b[both] + 1).tolist(), strict=True):
                out.append((a, x, b, y))
                a, b = x, y
        out.append((a, a_end, b, b_end))
    return np.array(out, dtype=np.int64).reshape(-1, 4)


def align_batch(encoder: Encoder, texts: list[str]) -> dict[str, pa.Array]:
    """Per text the ids of A and B, how many of each there are up to each cut, and the links."""
    ids = encoder.encode(texts)
    counts = tuple(np.array([len(x) for x in own], dtype=np.int64) for own in ids)
    flat = [np.concatenate([*own, np.zeros(0, dtype=np.int32)]) for own in ids]
    ends_a, ends_b = np.cumsum(encoder.sizes_a[flat[0]]), np.cumsum(encoder.sizes_b[flat[1]])
    links = lockstep(ends_a, ends_b, _lanes(texts, ends_a, ends_b, counts))
    out = {}
    begins = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
    bounds = np.searchsorted(links[0], begins[0])
    for name, values, begin, link in zip("ab", flat, begins, links, strict=True):
        text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
        out[f"{name}_ids"] = _list(begin, values)
        out[f"{name}_cuts"] = _list(bounds, link + 1 - begin[text_of])
    pairs = flat[0][links[0]].astype(np.int64) * len(encoder.bytes_b) + flat[1][links[1]]
    out["links"] = _list(bounds, pairs, pa.int64())
    for name, own in zip("ab", counts, strict=True):
        out[f"n_{name}"] = pa.array(own, pa.int64())
    out["groups"] = pa.array(_groups(encoder, flat, begins, links), pa.string())
    return out


def _groups(encoder: Encoder, flat: list[np.ndarray], begins: list[np.ndarray], links: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """Per text its groups as text. Every token goes to its place among those of both sides, with the
    sign that follows it there, and a text is one run of these."""
    sizes = [np.diff(link, prepend=-1) for link in links]
    before = [np.cumsum(sizes[1]) - sizes[1], np.cumsum(sizes[0])]
    merged = np.zeros(len(flat[0]) + len(flat[1]), dtype=np.int64)
    shift = 0
    for own, link, size, others, n in zip(flat, links, sizes, before, map(len, (encoder.bytes_a, encoder.bytes_b)), strict=True):
        entry = own.astype(np.int64) + shift
        entry[link] += n  # the last of its group
        merged[np.arange(len(own)) + np.repeat(others, size)] = entry
        shift += 2 * n
    signs, bounds = encoder.signs.__getitem__, (begins[0] + begins[1]).tolist()
    return ["".join(map(signs, merged[a:b].tolist()))[:-1] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _list(bounds: np.ndarray, values: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind or pa.int32()))


_OUTPUTS = {"n_a": "long", "n_b": "long", **dict.fromkeys(("a_ids", "b_ids", "a_cuts", "b_cuts"), "array<int>"),
            "links": "array<long>", "groups": "string"}
_encoders: dict[Vocabulary, Encoder] = {}


def _encoder(files: Vocabulary) -> Encoder:
    """The worker's tokenizers, kept from one task to the next."""
    if files not in _encoders:
        _encoders[files] = Encoder(files)
    return _encoders[files]


def align(
    docs: DataFrame, files: Vocabulary, doc_id: str = "doc_id", text: str = "text", outputs: Iterable[str] = tuple(_OUTPUTS)
) -> DataFrame:
    """Per document its id and the ``outputs``, of ``n_a``, ``n_b``, ``a_ids``, ``b_ids``, ``a_cuts``, ``b_cuts``,
    ``links`` and ``groups``, the groups' ids as text, A before B: ``1,2|3;4|5``.

    A encodes a space and the text, B the text, to which it adds the space; special tokens' strings are
    plain text. Cut k lies behind the first ``a_cuts[k]`` tokens of A and ``b_cuts[k]`` of B: there, and
    nowhere else, both end a token. The tokens between two cuts are a group, the last of A and B in it a
    link, given as the id of A times the size of B's vocabulary plus the id of B. Null and empty texts, and texts that a tokenizer doesn't give back byte by byte, have no
    tokens. Repeated rows get equal results, an empty table gives no rows, other columns aren't looked at.

    Tokenizers' files must lie at the same path on every executor. A batch is half a megabyte of
    texts or one longer text, which is encoded in pieces of that size, cut at spaces; only a stretch without
    a space is encoded whole (a few hundred bytes a byte in the tokenizers), and the ids and offsets of
    one text, about 50 bytes a token, are held at once.
    """
    outputs = list(outputs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(files)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                found = align_batch(encoder, [t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *[found[c] for c in outputs]], [doc_id, *outputs]
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        encode, ", ".join([f"`{doc_id}` {kind}", *[f"{c} {_OUTPUTS[c]}" for c in outputs]])
    )


def _parts(links: pa.Array, size: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows in parts of about so many links: where each row's begin (and the last one's end), and the links."""
    offsets, values = links.offsets.to_numpy(), links.values.to_numpy(zero_copy_only=False)
    row = 0
    while row < len(links):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield offsets[row : end + 1] - offsets[row], values[offsets[row] : offsets[end]]
        row = end


def pair_counts(spark: SparkSession, aligned: DataFrame, files: Vocabulary) -> DataFrame:
    """How many links of all documents hold each pair of ids: (a_id, b_id, n).

    Each task counts its links in one array over all possible pairs before anything moves.
    """
    encoder = Encoder(files)
    n_b = len(encoder.bytes_b)
    possible = spark.sparkContext.broadcast(encoder.pairs())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = possible.value
        totals = np.zeros(len(pairs), dtype=np.int64)
        for batch in batches:
            for _, links in _parts(batch.column("links")):
                found, n = np.unique(links, return_counts=True)
                totals[_places(pairs, found)] += n
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[some]), pa.array(totals[some])], ["pair", "n"])

    counted = aligned.select("links").mapInArrow(count, "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.floor(F.col("pair") / n_b).cast("int").alias("a_id"), (F.col("pair") % n_b).cast("int").alias("b_id"), "n"
    )


def _places(pairs: np.ndarray, found: np.ndarray) -> np.ndarray:
    at = np.searchsorted(pairs, found)
    if len(found) and not (pairs[np.minimum(at, len(pairs) - 1)] == found).all():
        raise ValueError("tokens are linked that don't end in the same bytes")
    return at


def link_scores(spark: SparkSession, counts: DataFrame, files: Vocabulary, links: Column) -> Column:
    """Column: struct of ``n_best``, the links whose pair is the most frequent of its token of B (ties
    included), and ``count_sum``, the sum of the pairs' counts over all links.

    The counts come to the driver and go to every task as arrays: they are at most as many as the
    possible pairs, some hundred thousand for these vocabularies, whatever the corpus.
    """
    encoder = Encoder(files)
    n_b, pairs = len(encoder.bytes_b), encoder.pairs()
    totals = np.zeros(len(pairs), dtype=np.int64)
    held = counts.select((F.col("a_id").cast("long") * n_b + F.col("b_id")).alias("pair"), "n").toArrow()
    totals[_places(pairs, held["pair"].to_numpy())] = held["n"].to_numpy()
    most = np.zeros(n_b, dtype=np.int64)
    np.maximum.at(most, pairs % n_b, totals)
    shared = spark.sparkContext.broadcast((pairs, totals, totals == most[pairs % n_b]))

    @F.arrow_udf("struct<n_best:long,count_sum:long>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs, totals, best = shared.value
        for links in batches:
            out: tuple[list, list] = ([], [])
            for bounds, linked in _parts(links):
                found, back = np.unique(linked, return_inverse=True)
                at = _places(pairs, found)[back]
                for values, column in zip((best, totals), out, strict=True):
                    column.append(np.diff(np.concatenate([[0], np.cumsum(values[at])])[bounds]))
            columns = [pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for c in out]
            yield pa.StructArray.from_arrays(columns, ["n_best", "count_sum"])

    return score(links)
