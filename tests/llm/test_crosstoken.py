import random
from bisect import bisect_left
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from common import clashing, table, texts

from tableflow.llm import crosstoken
from tableflow.llm.crosstoken import Encoder, align, lockstep, pair_counts
from tableflow.llm.queries import TOKENIZERS, op11_cross_tokenizer

ODD = ["  two  spaces ", "a\nb\tc", " ", "▁", "x▁y", "\U0001f600 x", "<|endoftext|> <s> </s> <0x41>", "ﬁ ℡", " x", "é é", "\x00", "word" * 900]


@pytest.fixture(scope="module")
def tokenizers_():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(TOKENIZERS.a)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=TOKENIZERS.b)


def byte_names():
    """Each byte by the character of byte-level vocabularies, read off the tokenizer's own decoder."""
    import tokenizers

    names = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    out = {}
    for point in [*range(0x800), *range(0x1000, 0x10000, 0x40), *range(0x10000, 0x110000, 0x10000)]:
        char = chr(point)
        if 0xD800 <= point < 0xE000:
            continue
        for name, byte in zip(names.pre_tokenize_str(char)[0][0], char.encode(), strict=True):
            out[name] = byte
    return out


def brute(values, a, b):
    """The contract by whole texts and plain loops."""
    names, tokens = byte_names(), []
    for text in values:
        if not text:
            tokens.append(([], []))
            continue
        whole = b" " + text.encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(names[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        fits = b"".join(bytes_a) == whole == b"".join(bytes_b)
        tokens.append((list(zip(ids_a, bytes_a)), list(zip(ids_b, bytes_b))) if fits else ([], []))
    rows, counts = [], Counter()
    for own_a, own_b in tokens:
        ends = []
        for own in (own_a, own_b):
            at, out = 0, {}
            for i, part in own:
                at += len(part)
                out[at] = i
            ends.append(out)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        pairs = [(ends[0][c], ends[1][c]) for c in cuts]
        counts.update(pairs)
        sides = [[[] for _ in cuts] for _ in ends]
        for own, side in zip(ends, sides, strict=True):
            for e, i in sorted(own.items()):
                side[bisect_left(cuts, e)].append(str(i))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides, strict=True)]
        rows.append((len(own_a), len(own_b), pairs, groups))
    most = Counter()
    for (x, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (n_a, n_b, len(groups), len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs),
         sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for n_a, n_b, pairs, groups in rows
    ], counts


def digests(spark, docs, monkeypatch):
    monkeypatch.setattr("tableflow.llm.queries.table", lambda *_: docs)
    return {r.doc_id: tuple(r)[1:] for r in op11_cross_tokenizer(spark, "").collect()}


def test_awkward_texts(spark, tokenizers_, monkeypatch):
    values = [*texts(), *ODD, "é " * 3000, "日本語" * 1500, "one two, three\n" * 2000]
    docs = clashing(table(spark, values), "a_ids", "b_ids", "a_cuts", "id", "n_best")
    expected, counts = brute(values, *tokenizers_)
    assert digests(spark, docs, monkeypatch) == dict(enumerate(expected))
    found = pair_counts(spark, align(docs, TOKENIZERS), TOKENIZERS).collect()
    assert {(r.a_id, r.b_id): r.n for r in found} == counts
    assert digests(spark, docs.limit(0), monkeypatch) == {}


def test_query(spark, tokenizers_):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    expected, _ = brute([d.text for d in docs], *tokenizers_)
    found = {r.doc_id: tuple(r)[1:] for r in op11_cross_tokenizer(spark, sf).collect()}
    assert found == dict(zip([d.doc_id for d in docs], expected, strict=True))


def test_words_are_encoded_as_the_whole(tokenizers_, monkeypatch):
    encoder, g = Encoder(TOKENIZERS), random.Random(3)
    parts = ["word", " ", "  ", "\n", "é", "日", "1,000", " a", "'s", " ", "\t ", "x\x1c ", "ab", "\xa0", " \xa0 ", "\u2003", "\x85 "]
    values = ["".join(g.choices(parts, k=300)) for _ in range(150)]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP0123456789'éßüñ日本語\u0300\U0001f600.,;-_/#$ \n"
    values += ["".join(g.choices(letters, k=400)) for _ in range(300)] + [f"{w}'s we'll {w.upper()} don'T" for w in ("aé", "x1")]
    a, b = tokenizers_
    whole = [a.encode(" " + v).ids for v in values], b.encode(values)
    assert encoder.cuts
    for piece, known in ((1 << 19, 200_000), (20, 50)):
        monkeypatch.setattr(crosstoken, "PIECE", piece)
        monkeypatch.setattr(crosstoken, "KNOWN", known)
        for own, other in zip(encoder.encode(values), whole, strict=True):
            assert [x.tolist() for x in own] == other


def test_twenty_megabytes():
    text = "some words, and others; é 日本\n " * 650_000
    found = crosstoken.align_batch(Encoder(TOKENIZERS), [text, "x"])
    a, b = (len(found[f"{n}_ids"][0]) for n in "ab")
    assert a > 4_000_000 and found["a_cuts"][0][-1].as_py() == a and found["b_cuts"][0][-1].as_py() == b


def test_lockstep_on_random_tokens():
    g = random.Random(9)
    for _ in range(200):
        ends, lanes, counts, base = ([], []), [], [0, 0], 0
        for _ in range(g.randint(0, 9)):
            size = g.randint(1, 30)
            own = [sorted({*g.sample(range(1, size + 1), g.randint(0, size)), size}) for _ in range(2)]
            lanes.append((counts[0], counts[0] + len(own[0]), counts[1], counts[1] + len(own[1])))
            for k in range(2):
                ends[k].extend(base + e for e in own[k])
                counts[k] += len(own[k])
            base += size
        a, b = (np.array(e, dtype=np.int64) for e in ends)
        got = lockstep(a, b, np.array(lanes, dtype=np.int64).reshape(-1, 4))
        meet = np.intersect1d(a, b)
        assert (a[got[0]] == meet).all() and (b[got[1]] == meet).all() and len(got[0]) == len(meet)


def test_possible_pairs_are_few():
    encoder = Encoder(TOKENIZERS)
    pairs = encoder.pairs()
    assert len(pairs) < sum(map(len, encoder.bytes_a)) + 2 * sum(map(len, encoder.bytes_b))
    n = len(encoder.bytes_b)
    for p in pairs[:: len(pairs) // 500].tolist():
        a, b = encoder.bytes_a[p // n], encoder.bytes_b[p % n]
        assert a.endswith(b) or b.endswith(a)
