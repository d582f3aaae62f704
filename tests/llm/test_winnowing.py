import hashlib

import pytest
from common import ALNUM, LOWER, clashing, sentence, table, texts

from check_queries import connect, difference
from tableflow.llm.queries import ORACLES, QUERIES
from tableflow.llm.winnowing import mark_overlap, overlap_counts


def words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def brute_force(values, items, window=10):
    out = []
    for text in values:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids.add(item_id)
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        out.append((len(w), len(hit), len(ids), digest, bool(hit)))
    return out


@pytest.fixture(scope="module")
def items():
    values = texts()
    long, other = words(values[10]), words(values[25])
    return [
        (11, " ".join(long[3:25])), (5, "; ".join(other[:10]).upper()), (2, " ".join(other[5:14])),
        (100, "naïve CAFÉ"), (7, "the the the the the the the the the the the the"), (8, ""), (9, None),
        (None, " ".join(long)), (11, " ".join(other[12:30])), (3, "日本"), (4, "never there at all"),
        (12, " ".join(long[20:31])),
    ]


def marked(spark, values, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = mark_overlap(table(spark, values), benchmark, **options)
    rows = out.select("doc_id", *overlap_counts(out)).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.doc_id)]


def test_overlap_equals_brute_force(spark, items):
    values = [*texts(), "the " * 40, " ".join(words(texts()[10])[:12])]
    usable = [(i, t) for i, t in items if i is not None and t is not None]
    expected = brute_force(values, usable)
    assert sum(e[-1] for e in expected) > 10
    assert marked(spark, values, items) == expected


def test_blocks_of_items_give_the_same_rows(spark, items):
    values = texts(copies=3)
    assert marked(spark, values, items, block_bytes=200) == marked(spark, values, items)


def test_every_shared_run_of_a_window_is_found(spark):
    import random

    g = random.Random(3)
    item = words(sentence(g, 60))
    values = [sentence(g, 7) + " " + " ".join(item[i : i + 10]) + " " + sentence(g, 5) for i in range(50)]
    assert [r[1] for r in marked(spark, values, [(1, " ".join(item))])] == [10] * 50
    values = [" ".join(item[i : i + 9]) for i in range(50)]
    assert [r[1] for r in marked(spark, values, [(1, " ".join(item))])] == [0] * 50


def test_no_items_no_rows_and_clashing_columns(spark, items):
    values = texts(copies=2)
    assert all(r[1:3] == (0, 0) for r in marked(spark, values, [(None, "a b")]))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = clashing(table(spark, values), "overlap", "items", "spans", "n_hit")
    out = mark_overlap(docs, benchmark)
    assert out.columns.count("overlap") == 1 and out.where("items = 'taken'").count() == len(values)
    assert mark_overlap(docs.limit(0), benchmark).count() == 0
    twice = docs.union(docs)
    assert mark_overlap(twice, benchmark).where("overlap.n_hit > 0").count() == 2 * out.where("overlap.n_hit > 0").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert difference(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None
