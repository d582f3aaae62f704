import random
from collections import defaultdict

from common import SPACES, clashing, table, texts

from tableflow.llm.linedup import patience, remove_repeated_blocks
from tableflow.llm.queries import op2_line_dedup


def test_patience_aligns_equal_lines_in_order():
    assert patience([1, 2, 3, 4], [1, 9, 3, 4]) == [(0, 0), (2, 2), (3, 3)]
    assert patience([5, 1, 2, 3, 6], [7, 1, 2, 3, 8]) == [(1, 1), (2, 2), (3, 3)]
    assert patience([], [1]) == [] and patience([1], []) == []
    g = random.Random(4)
    for _ in range(300):
        a, b = (g.choices(range(8), k=g.randrange(12)) for _ in range(2))
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    shuffled = list(range(50))
    moved = shuffled[30:] + shuffled[:30]
    assert len(patience(moved, shuffled)) == 30  # the longest increasing run


def brute_force(rows, min_words, rare):
    """Rows of (id, text) in order; the removed lines of each."""
    split = [[tuple(SPACES.findall(x)) for x in t.split("\n")] if t is not None else [] for _, t in rows]
    holders = defaultdict(set)
    pairs_of = defaultdict(set)
    for k, lines in enumerate(split):
        for i, line in enumerate(lines):
            if len(line) >= min_words:
                holders[line].add(k)
                if not (0 < i == len(lines) - 1):
                    pairs_of[line, lines[i + 1] if i + 1 < len(lines) else None].add(k)
    links = defaultdict(set)
    for line, ks in holders.items():
        if 1 < len(ks) <= rare:
            for k in ks:
                links[k].add(min(ks))
    for (line, _), ks in pairs_of.items():
        if len(holders[line]) > rare:
            for k in ks:
                links[k].add(min(ks))
    out = []
    for k, lines in enumerate(split):
        gone = set()
        full = [i for i, x in enumerate(lines) if x]
        for other in links[k] - {k}:
            pairs = patience([lines[i] for i in full], [x for x in split[other] if x])
            block = []
            for n, (i, j) in enumerate(pairs):
                if n and pairs[n - 1] != (i - 1, j - 1):
                    block = []
                block = [*block, full[i]]
                ends = n + 1 == len(pairs) or pairs[n + 1] != (i + 1, j + 1)
                if ends and sum(len(lines[x]) for x in block) >= min_words:
                    gone.update(block)
        out.append(sorted(gone))
    return out


def test_removed_lines_equal_brute_force(spark):
    values = [*texts(), *("\n".join(t.split()) for t in texts(2)[30:33] if t), "a b c d e\n" * 70, "a b c d e"]
    for min_words, rare in ((5, 50), (5, 3), (2, 1)):
        expected = brute_force(list(enumerate(values)), min_words, rare)
        assert sum(map(bool, expected)) > 10
        found = {r.doc_id: r for r in remove_repeated_blocks(
            table(spark, values), min_words=min_words, rare=rare).collect()}
        assert [found[i].removed for i in range(len(values))] == expected
        for i, text in enumerate(values):
            if text is not None:
                kept = [x for k, x in enumerate(text.split("\n")) if k not in set(expected[i])]
                assert found[i].text == "\n".join(kept)
                assert (found[i].n_lines, found[i].n_removed) == (len(text.split("\n")), len(expected[i]))
            else:
                assert found[i].text is None and found[i].n_lines == 0


def test_a_large_group_of_copies_leaves_the_first(spark):
    text = "one two three four five six\nseven eight nine ten eleven"
    docs = table(spark, [text] * 200)
    left = [r.doc_id for r in remove_repeated_blocks(docs, rare=20).where("text <> ''").collect()]
    assert left == [0]


def test_repeats_nulls_empty_tables_and_clashing_columns(spark):
    text = "one two three four five six"
    docs = table(spark, [text, text, text, None, "", text], ids=[5, 5, None, 6, 7, 8])
    out = remove_repeated_blocks(clashing(docs, "removed", "n_lines", "hashes", "first", "h", "id"))
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in out.collect())
    assert found == [(False, 5, 0), (False, 5, 0), (False, 6, 0), (False, 7, 0), (False, 8, 1), (True, 0, 1)]
    assert remove_repeated_blocks(docs.limit(0)).count() == 0
    assert "hashes" in out.columns and out.columns.count("removed") == 1


def test_query_equals_brute_force_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    found = {r.doc_id: r.removed for r in op2_line_dedup(spark, sf).collect()}
    expected = brute_force(rows, 5, 50)
    assert any(expected) and found == {i: e for (i, _), e in zip(rows, expected, strict=True)}


def test_a_line_is_deleted_however_many_documents_hold_it(spark):
    line = "this one line is held by many"
    for held in (40, 80):
        around = [[f"{side} {i} of its own words here" for side in ("before", "after")] for i in range(held)]
        # Between lines of the document's own, at its end, and at its start.
        values = ["\n".join((a, line, b) if i % 3 == 0 else (a, line) if i % 3 == 1 else (line, b))
                  for i, (a, b) in enumerate(around)]
        found = {r.doc_id: r.removed for r in remove_repeated_blocks(table(spark, values)).collect()}
        assert found == {i: [v.split("\n").index(line)] if i else [] for i, v in enumerate(values)}


def test_a_block_of_short_lines_is_found(spark):
    menu = "soup\n\nfish and rice\ntea\ncake"
    own = f"a line of its own here\n{menu}\nand one more of its own"
    values = [menu, menu, own, "soup\nfish and\ncake\ntea", "tea\ncake"]
    found = {r.doc_id: r.removed for r in remove_repeated_blocks(table(spark, values)).collect()}
    assert found == {0: [], 1: [0, 2, 3, 4], 2: [1, 3, 4, 5], 3: [], 4: []}


def test_a_block_is_aligned_with_its_source(spark):
    a, b = "the first line of the block", "and the second line of it"
    own = [f"line {i} of its own words" for i in range(4)]
    # The lines' first holder has them in another order.
    values = [f"{b}\n{a}", f"{own[0]}\n{a}\n{b}\n{own[1]}", f"{own[2]}\n{a}\n{b}\n{own[3]}"]
    found = {r.doc_id: r.removed for r in remove_repeated_blocks(table(spark, values)).collect()}
    assert len(found[1]) == 1 and found[2] == [1, 2] and found[0] == []


def every_earlier(rows, min_words):
    """The removed lines of each row if it is aligned with every earlier one, without candidates."""
    full = [
        [(i, tuple(SPACES.findall(x))) for i, x in enumerate((t or "").split("\n")) if SPACES.search(x)] for _, t in rows
    ]
    held = defaultdict(list)
    for k, lines in enumerate(full):
        for _, words in lines:
            if not held[words] or held[words][-1] != k:
                held[words].append(k)
    out = []
    for k, lines in enumerate(full):
        gone = set()
        for other in {e for _, words in lines for e in held[words] if e < k}:
            pairs = patience([x for _, x in lines], [x for _, x in full[other]])
            blocks = []
            for n, (i, j) in enumerate(pairs):
                if not n or pairs[n - 1] != (i - 1, j - 1):
                    blocks.append([])
                blocks[-1].append(lines[i])
            for block in blocks:
                if sum(len(words) for _, words in block) >= min_words:
                    gone.update(i for i, _ in block)
        out.append(sorted(gone))
    return out


def test_removed_lines_are_those_of_every_earlier_document(spark):
    g = random.Random(11)
    long, short = ([" ".join([f"{k}{i}"] * n) for i in range(30)] for k, n in (("l", 6), ("s", 2)))
    values = texts()
    for i in range(150):  # blocks of long and short lines, some of them held by over 50, and a line held by all
        start = g.randrange(10)
        block = [g.choice((long, short))[k] for k in range(start, start + g.randrange(2, 6))]
        values.append("\n".join([f"own words of the text {i}", *block, f"last words of text {i}", long[-1]]))
    expected = every_earlier(list(enumerate(values)), 5)
    found = {r.doc_id: r.removed for r in remove_repeated_blocks(table(spark, values)).collect()}
    assert all(set(found[i]) <= set(expected[i]) for i in found)
    missed = {i: set(e) - set(found[i]) for i, e in enumerate(expected) if set(e) - set(found[i])}
    assert sum(map(len, expected)) > 300 and not missed
