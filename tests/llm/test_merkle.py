import random
from hashlib import sha256
from zlib import crc32

import pytest
from common import clashing

from pyspark.sql import functions as F
from tableflow.llm.merkle import PersistentTree, fold, manifest
from tableflow.llm.queries import op12_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return sha256(text.encode()).hexdigest()


def row_digest(row):
    return digest("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def tree_root(nodes):
    while len(nodes) > 1:
        nodes = [digest("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0]


def siblings(nodes, at):
    out = []
    while len(nodes) > 1:
        pair = nodes[at // 2 * 2 : at // 2 * 2 + 2]
        out += [n for i, n in enumerate(pair) if i != at % 2]
        nodes = [digest("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at //= 2
    return out


def brute(rows, tampered):
    """The contract's rows, by whole trees built anew for every altered leaf."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, row_digest(r)))
        leaves[g] = [row_digest(r) for r in groups[g]]
    tops = [tree_root(leaves[g]) for g in names]
    out = []
    for k, g in enumerate(names):
        for at, row in enumerate(groups[g]):
            other = leaves[g][:]
            if tampered(row) and row["n_chars"] is not None:
                other[at] = row_digest({**row, "n_chars": row["n_chars"] + 1})
            folded = tree_root([*tops[:k], tree_root(other), *tops[k + 1 :]])
            proof = siblings(leaves[g], at) + siblings(tops, k)
            out.append((row["doc_id"], leaves[g][at], tops[k], tree_root(tops), digest("".join(proof)), folded))
    return sorted(map(repr, out))


def by_seven(row):
    return row["doc_id"] is not None and crc32(str(row["doc_id"]).encode()) % 7 == 0


def documents(count, seed=3):
    g = random.Random(seed)
    rows = []
    for i in range(count):
        lang = g.choices(["en", "de", "", None, "日本", "é"], [60, 5, 2, 3, 2, 1])[0]
        text = g.choice([None, "", "same", "x:1-", "long " * 500, f"text {i} é"])
        rows.append({"doc_id": g.choice([None, i, i, i, i]), "text": text, "lang": lang,
                     "source": g.choice([None, "", "a"]), "n_chars": g.choice([None, 0, len(text or "")])})
    return rows + rows[:5] + [{"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None}] * 3


def run(spark, rows, **options):
    docs = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    docs = clashing(docs.repartition(3), "grp", "id", "n", "leaf", "root", "digest", "pos")
    found = manifest(
        spark, docs, COLUMNS, altered={"n_chars": F.col("n_chars") + 1},
        where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, **options,
    )
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded_root")


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_equals_whole_trees(spark, levels):
    """Blocks of 2, 8 and 1,024 nodes: several rounds of blocks, one, and none."""
    rows = documents(90)
    found = run(spark, rows, block_levels=levels).collect()
    assert sorted(repr(tuple(r)) for r in found) == brute(rows, by_seven)


@pytest.mark.parametrize("count", [1, 2, 3])
def test_few_rows(spark, count):
    rows = [{"doc_id": 7 * i, "text": "t", "lang": "en", "source": "s", "n_chars": 1} for i in range(count)]
    assert sorted(repr(tuple(r)) for r in run(spark, rows).collect()) == brute(rows, by_seven)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert manifest(spark, docs, COLUMNS).collect() == []


def test_without_alterations_every_version_is_the_dataset(spark):
    rows = documents(40)
    docs = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    found = manifest(spark, docs, COLUMNS, block_levels=2).collect()
    assert len(found) == len(rows) and all(r.folded_root == r.root for r in found)
    assert all(fold(r.leaf.encode(), r.proof.encode(), r.sides).decode() == r.root for r in found)


def test_one_group_of_equal_rows(spark):
    """Rows that are equal in everything are leaves of their own, spread over tasks."""
    rows = [{"doc_id": None, "text": "t", "lang": "en", "source": "s", "n_chars": 1}] * 300
    found = run(spark, rows, block_levels=4).collect()
    assert sorted(repr(tuple(r)) for r in found) == brute(rows, by_seven)


def test_a_version_shares_all_but_the_ancestors():
    leaves = [digest(str(i)).encode() for i in range(100)]
    tree = PersistentTree(leaves, 7)
    before = len(tree.digests)
    version = tree.changed(77, digest("other").encode())
    assert len(tree.digests) == before + 8
    assert tree.digests[tree.root].decode() == tree_root([x.decode() for x in leaves])
    changed = [x.decode() for x in leaves]
    changed[77] = digest("other")
    assert tree.digests[version].decode() == tree_root(changed)


def test_long_text(spark):
    rows = [{"doc_id": i, "text": "é" * (10_000_000 if i == 1 else 3), "lang": "en", "source": "s", "n_chars": 1} for i in range(3)]
    assert sorted(repr(tuple(r)) for r in run(spark, rows).collect()) == brute(rows, by_seven)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = op12_merkle_manifest(spark, sf)
    assert sorted(
        repr(tuple(r)) for r in found.drop("verified").collect()) == brute(rows, by_seven)
    wrong = {r.doc_id for r in found.where("not verified").collect()}
    assert wrong == {r["doc_id"] for r in rows if by_seven(r)}
