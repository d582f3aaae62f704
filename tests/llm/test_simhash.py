from itertools import combinations

import xxhash
from common import clashing, table, texts

from tableflow.llm.components import components
from tableflow.llm.queries import op6_simhash_near_dedup
from tableflow.llm.similar import SYMBOLS, _masks, one_of_each, similar_documents
from tableflow.llm.simhash import covering_masks, links, near_duplicates


def brute_force(values, size):
    prints = []
    for text in values:
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return prints


def grouped(prints, ids):
    least = dict(zip(ids, ids, strict=True))
    changed = True
    while changed:
        changed = False
        for (a, x), (b, y) in combinations(zip(ids, prints, strict=True), 2):
            if (x ^ y).bit_count() <= 2 and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_masks_cover_every_pair_of_bits():
    masks = covering_masks(2)
    assert len(masks) == 7
    for i, j in combinations(range(64), 2):
        assert any(not (m >> i & 1 or m >> j & 1) for m in masks)


def test_near_duplicates_equal_brute_force(spark):
    values = texts()
    for size in (3, 5):
        found = {r.id: r for r in near_duplicates(table(spark, values), size=size).collect()}
        prints = brute_force(values, size)
        assert [found[i].fingerprint for i in range(len(values))] == [signed(p) for p in prints]
        assert {i: r.component_id for i, r in found.items()} == grouped(prints, list(range(len(values))))


def test_links_of_a_dense_group(spark):
    base = 0x0123456789ABCDEF
    prints = [base, base ^ 1, base ^ 3, base ^ 7, base ^ 15, base ^ (1 << 63), base ^ (7 << 40), ~base & (1 << 64) - 1]
    prints += [base ^ 1 << k for k in range(10, 30)]
    df = spark.createDataFrame([(signed(p),) for p in prints], "f long")
    edges = links(df, "f")
    for e in edges.collect():
        assert ((e.a ^ e.b) & (1 << 64) - 1).bit_count() <= 2
    roots = {r.node: r.root for r in components(edges).collect()}
    expected = grouped([p & (1 << 64) - 1 for p in prints], [signed(p) for p in prints])
    assert {p: roots.get(p, p) for p in expected} == expected


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def similar_groups(values, ids, similarity=0.8):
    """Least id of each component of the links between all pairs of texts of that similarity."""
    sets, least, changed = [shingles(v) for v in values], list(ids), True
    pairs = [
        (i, j) for i, j in combinations(range(len(ids)), 2)
        if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in pairs:
            if least[i] != least[j]:
                least[i] = least[j] = min(least[i], least[j])
                changed = True
    return dict(zip(ids, least, strict=True))


def edited(seed):
    """Texts of about a hundred words, each with copies in which one to five words differ."""
    import random

    from common import sentence

    g, out = random.Random(seed), []
    for _ in range(25):
        words = sentence(g, 110).split()
        out.append(" ".join(words))
        for edits in (1, 2, 4, 5, 12):
            other = list(words)
            for at in g.sample(range(110), edits):
                other[at] = "changed" + str(g.randrange(10**6))
            out.append(" ".join(other))
    return out


def test_masks_leave_out_any_few_symbols_of_a_set():
    for lost in combinations(range(SYMBOLS), 3):
        assert any(not set(kept) & set(lost) for kept in _masks()[:15])


def test_similar_documents_equal_all_pairs(spark):
    values = [*texts(), *edited(3)]
    found = {r.id: r.component_id for r in similar_documents(table(spark, values)).collect()}
    expected = similar_groups(values, list(range(len(values))))
    assert found == expected and len(set(expected.values())) < len(values) - 60


def test_similar_rows_repeat_ids_are_null_and_share_ids(spark):
    a, b = edited(4)[0], edited(4)[6]
    docs = table(spark, [a, a, b, b + " more", None, "", a], ids=[4, 4, 4, None, None, 9, None])
    found = sorted((r.id is None, r.id or 0, r.component_id) for r in similar_documents(docs).collect())
    assert found == [(False, 4, 4), (False, 4, 4), (False, 4, 4), (False, 9, 9), (True, 0, 4), (True, 0, 4), (True, 0, 9)]
    assert similar_documents(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 300).selectExpr("id as a", "id - 1 as b")
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges.limit(0)).count() == 0


def test_rows_repeat_ids_are_null_and_columns_clash(spark):
    docs = table(spark, ["a b c d e f g"] * 3 + [None, ""], ids=[4, 4, None, 9, None])
    found = sorted((r.id is None, r.id or 0, r.component_id) for r in near_duplicates(docs).collect())
    assert found == [(False, 4, 4), (False, 4, 4), (False, 9, 9), (True, 0, 4), (True, 0, 9)]
    left = one_of_each(clashing(docs, "id", "version", "component_id"))
    assert sorted(r.doc_id for r in left.collect()) == [4, 9]
    assert set(left.columns) >= {"doc_id", "text", "id", "component_id"}
    assert near_duplicates(docs.limit(0)).count() == 0 and one_of_each(docs.limit(0)).count() == 0


def test_query_equals_brute_force_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash_near_dedup(spark, sf).collect()}
    prints, ids = brute_force([r.text for r in rows], 3), [r.doc_id for r in rows]
    least = grouped(prints, ids)
    assert found == {i: (f"{p:016x}", least[i]) for i, p in zip(ids, prints, strict=True)}


def template_family(members, pairs, seed):
    """Texts with about 0.66 of their shingles from one template, and among them pairs of similarity 0.8 to
    0.9; returns the texts and the places of the pairs."""
    import random

    g = random.Random(seed)
    word = lambda: f"w{g.randrange(10**9)}"
    head = [word() for _ in range(84)]
    out = [" ".join(head + [word() for _ in range(20)]) for _ in range(members)]
    planted = []
    for k in range(pairs):
        at = g.randrange(members)
        words = out[at].split()
        # A run of changed words takes its length and four more of the shingles.
        run = g.choice([1, 2, 3, 4, 5, 6])
        words[-run - 4 : -4] = [word() for _ in range(run)]
        planted.append((at, len(out)))
        out.append(" ".join(words))
    return out, planted


def test_pairs_among_many_texts_of_one_template(spark):
    values, planted = template_family(2500, 60, 3)
    sets = [shingles(v) for v in values]
    alike = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in planted}
    assert max(len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(2000)) < 0.8
    found = {r.id: r.component_id for r in similar_documents(table(spark, values)).collect()}
    expected = {pair for pair, j in alike.items() if j >= 0.8}
    assert len(expected) > 40 and min(alike[p] for p in expected) < 0.84
    assert {p for p in planted if found[p[0]] == found[p[1]]} == expected
    copies = len({i for i, _ in expected})
    assert len(set(found.values())) >= len(values) - len(expected) and copies


def test_the_smallest_member_joins_texts_with_a_template_alone_in_common(spark):
    """No shingle is shared but the template's; each text is similar to the shortest, few to each other."""
    import random

    g = random.Random(8)
    word = lambda: f"v{g.randrange(10**9)}"
    head = [word() for _ in range(84)]
    values = [" ".join(head + [word() for _ in range(g.randint(8, 19))]) for _ in range(300)] + [" ".join(head)]
    found = {r.id: r.component_id for r in similar_documents(table(spark, values)).collect()}
    assert set(found.values()) == {0} == set(similar_groups(values, list(range(len(values)))).values())


def test_pairs_are_found_among_texts_of_frequent_shingles_alone(spark):
    """Each text has one of 36 parts in each of three places of a template, so more than 32 texts hold any
    shingle. Those with two parts in common have a similarity of 0.82, others 0.67 and less."""
    import random

    g, many = random.Random(11), 36
    words = lambda n: " ".join(f"u{g.randrange(10**9)}" for _ in range(n))
    fixed, parts = [words(21) for _ in range(4)], [[words(6) for _ in range(many)] for _ in range(3)]
    codes = [(a, b, (a + b) % many) for a in range(many) for b in range(many)]
    codes += [(a, b, (a + b + g.randrange(1, many)) % many) for a, b, _ in g.sample(codes, 40)]
    values = [" ".join([*(x for k in range(3) for x in (fixed[k], parts[k][c[k]])), fixed[3]]) for c in codes]
    sets = [shingles(v) for v in values]
    groups, least = {}, list(range(len(codes)))
    for i, c in enumerate(codes):
        for k in range(3):
            groups.setdefault((k, c[:k] + c[k + 1 :]), []).append(i)
    links = {pair for own in groups.values() for pair in combinations(own, 2)}
    assert all(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in links) and len(links) > 100
    apart = [pair for pair in (g.sample(range(len(codes)), 2) for _ in range(2000)) if tuple(sorted(pair)) not in links]
    assert max(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in apart) < 0.7
    for _ in codes:
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    found = {r.id: r.component_id for r in similar_documents(table(spark, values)).collect()}
    assert found == dict(enumerate(least)) and len(set(least)) > 1000
