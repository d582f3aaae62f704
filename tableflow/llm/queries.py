"""The registered queries of this package, with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm import crosstoken, linedup, merkle, packing, quality, rules, secretscan, simhash, suffix, toxicity, viterbi, warc, winnowing
from tableflow.llm.rows import stored
from tableflow.llm.text import fold
from tableflow.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The vocabulary of op3: a SentencePiece file of the installed public tokenizers.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Those of op11.
TOKENIZERS = crosstoken.Vocabulary("/opt/tokenizers/byte_bpe_50k.json", VOCABULARY)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linedup.remove_repeated_blocks(docs)
    return out.select("doc_id", "n_lines", "n_removed", "removed", F.sha2(out["text"].cast("binary"), 256).alias("kept_sha256"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = viterbi.token_counts(spark, F.col("text"), *viterbi.read_pieces(VOCABULARY))
    return docs.select("doc_id", counted.alias("t")).select("doc_id", "t.n_tokens", "t.score")


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    rows = quality.featured(docs, labels, fold(F.col("doc_id"), 3) != 1)
    model = quality.fit(rows)
    scored = rows.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 3) == 1).alias("held_out"),
                         model.score(F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    marked = winnowing.mark_overlap(docs.select("doc_id", "text"), benchmark)
    return marked.select("doc_id", *winnowing.overlap_counts(marked))


ORACLES["op5_decontamination"] = r"""
    with words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
    ), items as (
        select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
    ), windows as (
        select distinct item_id, least(10, len(w)) as n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') as g
        from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)
    ), sizes as (select distinct n from windows),
    grams as (
        select doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as g
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, sizes where len(w) >= n)
    ), hits as (select doc_id, item_id, i, n from grams join windows using (n, g)),
    hit_words as (
        select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as p from hits) group by 1
    ), hit_items as (
        select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
        from (select distinct doc_id, cast(item_id as varchar) as id from hits) group by 1
    )
    select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from words left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix.repeated_spans(docs)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0))
    return out.select(
        "doc_id", n_bytes.cast("long").alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.floor(F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLES["op7_suffix_dedup"] = """
    with bytes as (
        select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n_bytes from documents
    ), windows as (
        select doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) as k
        from (select doc_id, h, unnest(range(n_bytes - 99)) as s from bytes where n_bytes >= 100)
    ), repeated as (
        select doc_id, s from (
            select doc_id, s, row_number() over (partition by k order by doc_id, s) as nth from windows) where nth > 1
    ), marked as (
        select doc_id, s, sum(new) over (partition by doc_id order by s) as span
        from (select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as new
              from repeated)
    ), spans as (
        select doc_id, span, min(s) as a, max(s) + 100 as b from marked group by doc_id, span
    ), gaps as (
        select doc_id, span, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as since from spans
    ), cut as (
        select doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last,
               string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' order by a) as front
        from gaps join bytes using (doc_id) group by doc_id
    )
    select doc_id, cast(n_bytes as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
           coalesce(n_spans, 0) as n_spans,
           sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
    from bytes left join cut using (doc_id)
"""


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    trusted = labels.where("quality = 1").select(F.col("doc_id").alias("id"))
    return rules.quality_rules(docs, trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept"
    )


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    manifest = warc.write_archives(warc.page_records(table(spark, sf_dir, "pages")), folder)
    found = warc.read_archives(spark, manifest, folder, payloads=False)
    return found.select(
        warc.page_number(F.col("id")).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


ORACLES["op9_warc"] = """
    with payloads as (
        select page_id, coalesce(html, '') as html, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes from pages
    ), latest as (select html, max(page_id) as last from payloads where payload_bytes >= 1000 group by html)
    select page_id, payload_bytes, sha1(html) as payload_digest,
           case when page_id < last then 'revisit' else 'response' end as record_type,
           case when page_id < last then last end as refers_to
    from payloads left join latest using (html)
"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, fold(F.col("doc_id"), 4) != 2)
    scored = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
                         model.score(docs, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = lambda c: F.size(c).cast("long")
    aligned = crosstoken.align(docs, TOKENIZERS, outputs=["n_a", "n_b", "links", "groups"])
    rows = stored(spark, aligned.select(
        "doc_id", "n_a", "n_b", size("links").alias("n_groups"), size("links").alias("n_links"), "links",
        F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
    ), "aligned")
    counts = crosstoken.pair_counts(spark, rows, TOKENIZERS)
    scores = crosstoken.link_scores(spark, counts, TOKENIZERS, F.col("links"))
    return rows.withColumn("scores", scores).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "scores.n_best", "scores.count_sum", "groups_sha256"
    )


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    proved = merkle.manifest(
        spark, docs, ["doc_id", "source", "lang", "n_chars", "text"],
        altered={"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1},
        where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
    )
    return proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# CRC-32 in SQL: eight shifts for each byte of the id, whose bytes enter at every eighth.
ORACLES["op12_merkle_manifest"] = """
    with recursive entries as (
        select doc_id, coalesce('+' || lang, '') as g, n_chars,
               coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') as front,
               coalesce(strlen(text) || ':' || text, '-') as back,
               list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
                   range(1, strlen(doc_id::varchar) + 1), lambda i: [ascii(substr(doc_id::varchar, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]))),
                   lambda c, x: case when xor(c, x) & 1 = 1 then xor(xor(c, x) >> 1, 3988292384) else xor(c, x) >> 1 end) as crc
        from documents
    ), leaves as (
        select doc_id, g, sha256(front || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || back) as leaf,
               case when xor(crc, 4294967295) % 7 = 0
                    then sha256(front || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || back) end as other
        from entries
    ), ranked as (
        select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos,
               count(*) over (partition by g) as n from leaves
    ), tree as (
        select g, 0 as level, pos, leaf as h, n from ranked
        union all
        select g, level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (any_value(n) + 1) // 2
        from tree where n > 1 group by g, level, pos // 2
    ), subroots as (
        select g, h as subroot, row_number() over (order by g) - 1 as pos, count(*) over () as n from tree where n = 1
    ), top as (
        select 0 as level, pos, subroot as h, n from subroots
        union all
        select level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (any_value(n) + 1) // 2
        from top where n > 1 group by level, pos // 2
    ), steps as (
        select r.g, r.pos, t.level, case when s.h is null then '-' when r.pos >> t.level & 1 = 1 then 'L' || s.h else 'R' || s.h end as step
        from ranked r join tree t on t.g = r.g and t.pos = r.pos >> t.level and t.n > 1
        left join tree s on s.g = r.g and s.level = t.level and s.pos = xor(t.pos, 1)
    ), top_steps as (
        select r.g, t.level, case when s.h is null then '-' when r.pos >> t.level & 1 = 1 then 'L' || s.h else 'R' || s.h end as step
        from subroots r join top t on t.pos = r.pos >> t.level and t.n > 1
        left join top s on s.level = t.level and s.pos = xor(t.pos, 1)
    ), up as (select g, pos, list(step order by level) as steps from steps group by g, pos),
    top_up as (select g, list(step order by level) as steps from top_steps group by g),
    proved as (
        select doc_id, leaf, other, subroot, (select h from top where n = 1) as root,
               list_concat(coalesce(u.steps, []), coalesce(t.steps, [])) as steps
        from ranked r join subroots using (g) left join up u on u.g = r.g and u.pos = r.pos left join top_up t on t.g = r.g
    ), folded as (
        select *, list_reduce(list_prepend(coalesce(other, leaf), steps),
                   lambda h, s: sha256(case s[1] when 'L' then s[2:] || h when 'R' then h || s[2:] else h end)) as folded_root
        from proved
    )
    select doc_id, leaf, subroot, root,
           sha256(array_to_string(list_transform(steps, lambda s: replace(s[2:], '-', '')), '')) as proof_sha256,
           folded_root, folded_root = root as verified
    from folded
"""


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secretscan.find_secrets(spark, F.col("text")).alias("found"))
    base = [r.kind for r in secretscan.BASE]
    entries = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda *kinds: F.filter("found", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(entries(of(*base)), 256).alias("base_sha256"), entries(F.col("found")).alias("spans"),
    )


def _secrets_sql() -> str:
    numbered = [*enumerate(secretscan.BASE + secretscan.MORE)]
    text = lambda expression: expression.replace("'", "''")
    rules = ", ".join(f"({i}, '{r.kind}', {r.least})" for i, r in numbered)
    # Matches are set between two control characters, which no rule takes; the pieces then alternate.
    searches = " union all ".join(
        f"""select doc_id, {i} as k, unnest(p) as piece, unnest(range(len(p))) as i from (select doc_id, string_split_regex(
        regexp_replace(t, '({text(r.expression)})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) as p from texts)"""
        for i, r in numbered
    )
    tails = " ".join(
        f"when {i} then regexp_extract(piece, '^{text(r.head)}({r.tail}+)$', {r.head.count('(') + 1})" for i, r in numbered
    )
    return f"""
    with texts as (select doc_id, translate(coalesce(text, ''), chr(1), chr(3)) as t from documents),
    rules (k, kind, least) as (values {rules}),
    pieces as ({searches}),
    placed as (
        select doc_id, k, i, piece, length(piece) as n,
               sum(length(piece)) over (partition by doc_id, k order by i) as stop from pieces
    ), found as (
        select doc_id, k, kind, cast(stop - n as bigint) as start, kind || ':' || cast(stop - n as bigint) || ':' || cast(stop as bigint) as entry
        from placed join rules using (k) where i % 2 = 1 and length(case k {tails} end) >= least
    )
    select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
           count(*) filter (kind = 'hex') as n_hex,
           sha256(coalesce(string_agg(entry, ',' order by start, k) filter (k < 3), '')) as base_sha256,
           coalesce(string_agg(entry, ',' order by start, k), '') as spans
    from documents left join found using (doc_id) group by doc_id
    """


ORACLES["op13_secret_scan"] = _secrets_sql()
