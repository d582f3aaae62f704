import hashlib

import pytest
from common import clashing, table, texts

from tableflow.llm.queries import op7_suffix_dedup
from tableflow.llm.suffix import repeated_spans


def brute_force(rows, length):
    """Rows in order of (id, text's rank); spans of each."""
    seen, out = set(), []
    for text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                gone[s : s + length] = [True] * length
            seen.add(data[s : s + length])
        edges = [i for i in range(len(data) + 1)
                 if (i < len(data) and gone[i]) != (i > 0 and gone[i - 1])]
        out.append(edges)
    return out


@pytest.mark.parametrize(("length", "hot"), [(100, 256), (40, 256), (40, 1), (33, 2)])
def test_spans_equal_brute_force(spark, length, hot):
    values = texts(copies=6)
    found = {r.doc_id: r for r in repeated_spans(table(spark, values), length=length, hot=hot).collect()}
    expected = brute_force(values, length)
    assert any(expected)
    for i, (text, edges) in enumerate(zip(values, expected, strict=True)):
        assert found[i].spans == edges
        data = (text or "").encode()
        cuts = [0, *edges, len(data)]
        assert found[i].kept == b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))


def test_repeated_rows_are_one_document_and_null_ids_come_last(spark):
    text = texts()[10]
    docs = table(spark, [text, text, text, text + " x"], ids=[7, 7, None, 9])
    found = sorted((r.doc_id is None, r.doc_id, r.spans) for r in repeated_spans(docs).collect())
    n = len(text.encode())
    assert found == [(False, 7, []), (False, 7, []), (False, 9, [0, n]), (True, None, [0, n])]


def test_empty_table_and_clashing_columns(spark):
    docs = table(spark, texts(copies=2))
    assert repeated_spans(docs.limit(0)).count() == 0
    plain = {r.doc_id: r.spans for r in repeated_spans(docs).collect()}
    other = repeated_spans(clashing(docs, "spans", "code", "part", "ids", "id"))
    assert {r.doc_id: r.spans for r in other.collect()} == plain
    assert other.columns.count("spans") == 1 and "code" in other.columns


def test_query_equals_brute_force_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in op7_suffix_dedup(spark, sf).collect()}
    for r, edges in zip(rows, brute_force([r.text for r in rows], 100), strict=True):
        data = (r.text or "").encode()
        cuts = [0, *edges, len(data)]
        kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
        assert tuple(found[r.doc_id])[1:] == (
            len(data), len(data) - len(kept), len(edges) // 2, hashlib.sha256(kept).hexdigest()
        )
