from collections import Counter, defaultdict

from common import SPACES, clashing, same_without_order, table, texts

from tableflow.llm.packing import Bins, best_fit
from tableflow.llm.queries import op1_best_fit_packing


def brute_force(items, capacity):
    """Looks at every open bin for every item."""
    bins, out = [], []
    for size, source, cluster in items:
        fitting = [
            (b["room"], b["made"]) for b in bins
            if b["room"] >= size and source not in b["sources"] and cluster not in b["clusters"]
        ]
        if fitting:
            room = min(fitting)[0]
            out.append(("room", room))
            candidates = [b for b in bins if b["room"] == room and source not in b["sources"]
                          and cluster not in b["clusters"]]
            chosen = candidates[0]
        else:
            out.append(("new", capacity))
            chosen = {"room": capacity, "sources": set(), "clusters": set(), "made": len(bins)}
            bins.append(chosen)
        chosen["room"] -= size
        chosen["sources"].add(source)
        chosen["clusters"].add(cluster)
    return out


def test_search_goes_on_to_the_tightest_compatible_bin():
    bins = Bins(10)
    a = bins.place(6, 1, 0)  # 4 left
    b = bins.place(5, 2, 0)  # 5 left
    assert bins.place(4, 1, 0) == b  # the tighter bin has the source already
    assert bins.place(4, 2, 0) == a
    assert bins.place(1, 4, 8) == b
    c = bins.place(2, 4, 8)
    assert c not in (a, b)
    assert bins.place(8, 8, 16) == c and bins.filled == 0


def test_each_choice_is_a_tightest_one():
    """With equal items of unlike source and cluster, choices differ only among equal bins."""
    import random

    g = random.Random(2)
    sizes = sorted((g.randint(1, 60) for _ in range(300)), reverse=True)
    items = [(s, 1 << k, 1 << k) for k, s in enumerate(sizes)]
    bins = Bins(100)
    rooms = defaultdict(lambda: 100)
    found = []
    for size, source, cluster in items:
        known = len(rooms)
        b = bins.place(size, source, cluster)
        found.append(("room", rooms[b]) if b < known else ("new", 100))
        rooms[b] -= size
    assert found == brute_force(items, 100)


def check(rows, values, capacity, sources):
    by_bin, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_bin[r.bin].append(r)
        by_doc[r.doc_id].append(r)
    for content in by_bin.values():
        assert sum(r.n_tokens for r in content) <= capacity
        assert sorted(r.slot for r in content) == list(range(len(content)))
        named = [r.source for r in content if r.source is not None]
        assert len(set(named)) == len(named)
        assert len({r.cluster for r in content}) == len(content)
    for i, text in enumerate(values):
        n = len(SPACES.findall(text or ""))
        parts = sorted(by_doc.get(i, []), key=lambda r: r.part)
        assert [r.start for r in parts] == list(range(0, n, capacity))
        assert sum(r.n_tokens for r in parts) == n
        assert all(r.source == sources[i] for r in parts)
    return len(by_bin)


def test_bins_hold_no_conflict_and_every_token_once(spark):
    values = texts()
    docs = table(spark, values)
    sources = {r.doc_id: r.source for r in docs.collect()}
    for shard_tokens in (1 << 21, 500):
        rows = best_fit(docs, capacity=256, shard_tokens=shard_tokens).collect()
        check(rows, values, 256, sources)
    again = best_fit(docs.repartition(5, "text"), capacity=256)
    assert same_without_order(again) == same_without_order(best_fit(docs, capacity=256))


def test_repeats_nulls_empty_tables_and_clashing_columns(spark):
    docs = table(spark, ["a b c"] * 4 + [None, ""], ids=[1, 1, None, 3, 4, 5])
    rows = best_fit(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "3", "None"]
    assert len({r.bin for r in rows}) == 4  # equal texts never share a bin
    assert best_fit(docs.limit(0)).count() == 0
    assert best_fit(clashing(docs, "bin", "slot", "words", "shard", "cluster")).count() == 4


def test_query_packs_every_word(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    assert [d.doc_id for d in docs] == list(range(len(docs)))
    rows = op1_best_fit_packing(spark, sf).collect()
    bins = check(rows, [d.text for d in docs], 2048, {d.doc_id: d.source for d in docs})
    assert bins < len(docs)


def test_repeated_rows_and_null_ids_are_spread_over_shards(spark):
    for value in (lambda i: "a b c d e", lambda i: f"a b c d w{i}"):  # one text; texts of one length
        docs = spark.createDataFrame([(None, value(i), "s") for i in range(4000)], "doc_id long, text string, source string")
        found = best_fit(docs, shard_tokens=1000).collect()
        shards = Counter(r.bin >> 32 for r in found)
        assert len(found) == 4000 and len(shards) > 8 and max(shards.values()) < 1000
        assert len({r.bin for r in found}) == 4000  # of one source
