"""Quality rules: base counts, and a likelihood ratio of hashed n-grams. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.rows import stored

SPACES = "[ \\t-\\r]+"
TRIMMED = " \t\n\x0b\f\r"
SYMBOLS = "[^#*$%&|<>]+"


def with_words(docs: DataFrame, text: str, name: str = "__words") -> DataFrame:
    """The documents with their words (runs without ASCII spaces); a null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(TRIMMED))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    return docs.withColumn(name, words)


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and
    ``base_failed``.

    Windows of five words are compared by a 64-bit hash. Work on a text is linear but for the sort of
    the windows of texts that repeat any; nothing leaves its row, so no shuffle is needed.
    """
    whole = F.coalesce(text, F.lit(""))
    docs = with_words(docs, text)
    n = F.size("__words")
    starts = F.when(n >= 5, F.sequence(F.lit(0), n - 5)).otherwise(F.array().cast("array<int>"))
    docs = docs.withColumn("__windows", F.transform(
        starts, lambda i: F.xxhash64(*(F.get("__words", i + k) for k in range(5)))
    ))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(TRIMMED)) != "")
    docs = docs.withColumn("__lines", lines)
    # Sorted with their places, and only for texts where some window repeats.
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    docs = docs.withColumn("__sorted", F.when(repeats, F.sort_array(
        F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )))
    hash_at = lambda i: F.get("__sorted", i)["h"]
    docs = docs.withColumn("__places", F.sort_array(F.transform(
        F.filter("__sorted", lambda x, i: (x["h"] == hash_at(i + 1)).eqNullSafe(True)
                 | (x["h"] == F.when(i > 0, hash_at(i - 1))).eqNullSafe(True)),
        lambda x: x["i"],
    )))
    # Windows that begin at the places cover five words each, or up to the next such place.
    covered = F.aggregate(
        "__places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(5), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    counts = {
        "n_words": n.cast("long"),
        "word_chars": F.char_length(F.regexp_replace(whole, SPACES, "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(whole, SYMBOLS, "")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }
    docs = docs.withColumns(counts).drop("__windows", "__lines", "__sorted", "__places", "__words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return docs.withColumn("base_failed", failed)


def log_ratios(
    docs: DataFrame, target: DataFrame, doc_id: str, text: str, buckets: int
) -> list[float]:
    """For every bucket, the log of its share of the target's n-grams over its share of the corpus's.

    Both are multinomials over hashed words and pairs of neighbouring words. One is added to each
    of the corpus's counts, and the corpus's shares, as if seen in ``buckets`` n-grams, to the
    target's: few trusted documents say little, and without any all ratios are zero. ``target`` has
    the ids of the trusted documents. Tasks count before they shuffle, so ``buckets`` rows a task
    move, however frequent a word is; the result has ``buckets`` numbers.
    """
    spark = docs.sparkSession
    trusted = target.select(F.col("id").alias("__id"), F.lit(1).alias("__t")).distinct()
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"))
    # Texts move once and aren't sorted; the plan is the same however many documents are trusted.
    rows = rows.join(trusted.hint("shuffle_hash"), "__id", "left")
    rows = with_words(rows.select("text", F.coalesce("__t", F.lit(0)).alias("t")), "text")
    following = F.slice("__words", 2, F.greatest(F.size("__words"), F.lit(1)))
    zipped = F.arrays_zip(F.col("__words").alias("a"), following.alias("b"))
    pairs = rows.select("t", F.explode(zipped).alias("g"))
    grams = pairs.select("t", F.explode(F.array(
        F.pmod(F.xxhash64("g.a"), F.lit(buckets)),
        F.when(F.col("g.b").isNotNull(), F.pmod(F.xxhash64("g.a", "g.b"), F.lit(buckets))),
    )).alias("bucket")).where("bucket is not null")
    counted = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("t").alias("target"))
    counted = spark.range(buckets).withColumnRenamed("id", "bucket").join(counted, "bucket", "left")
    counted = stored(spark, counted.na.fill(0), "ngrams")
    raw, trusted = counted.agg(F.sum("raw"), F.sum("target")).first()
    share = (F.col("raw") + 1) / (raw + buckets)
    ratio = F.log((F.col("target") / share + buckets) / (trusted + buckets))
    return [r[0] for r in counted.orderBy("bucket").select(ratio).collect()]


def quality_rules(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
    buckets: int = 10_000, threshold: float = -0.1,
) -> DataFrame:
    """The documents with the columns of :func:`base_rules`, ``ratio`` and ``kept``.

    ``ratio`` is the mean over a text's words and pairs of neighbouring words of the log-likelihood
    ratio between the trusted documents (ids in column ``id`` of ``target``) and the raw corpus. A
    document is kept if the base rules pass it and its ratio is at least ``threshold``, always the
    same decision for the same corpus. Counts cover all documents. Without trusted documents no
    ratio speaks against a text.

    Rows stay as they are: null and empty texts have no words, a ratio of 0, and fail the base
    rules; repeated rows get equal results and count as often as they occur; input columns with
    names of the result are replaced. The plan holds the ratios as one array of ``buckets`` numbers.
    """
    ratios = log_ratios(docs, target, doc_id, text, buckets)
    # A constant to the optimizer, which folds it into one array.
    weights = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    docs = with_words(base_rules(docs, text), text)
    following = F.slice("__words", 2, F.greatest(F.size("__words"), F.lit(1)))
    at = lambda *words: F.get(weights, F.pmod(F.xxhash64(*words), F.lit(buckets)).cast("int"))
    each = F.zip_with("__words", following, lambda a, b: at(a) + F.when(b.isNull(), F.lit(0.0)).otherwise(at(a, b)))
    total = F.aggregate(each, F.lit(0.0), lambda acc, x: acc + x)
    n_grams = F.greatest(2 * F.size("__words") - 1, F.lit(1))
    docs = docs.withColumn("ratio", total / n_grams).drop("__words")
    return docs.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))
