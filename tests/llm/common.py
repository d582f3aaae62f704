"""Small documents with the awkward cases, and brute-force versions used by several tests."""

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
SPACES = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(generator, words):
    return " ".join("".join(generator.choices("abcdeéß", k=generator.randint(2, 7))) for _ in range(words))


def texts(seed=1, copies=12):
    """Texts with copies, near copies, shared lines, repeats, nulls, empty and long ones."""
    g = random.Random(seed)
    line = sentence(g, 9)
    base = [sentence(g, 30) + "\n" + sentence(g, 20) for _ in range(8)]
    out = [None, "", " \n\t ", "x", "a b", line, line, "\n" + line + "\n", "ab " * 400, "z" * 700]
    out += [base[0]] * copies
    out += [b.replace("a", "A", 1) for b in base] + base[:3]
    out += [base[1].replace("b", "c", 1), base[1] + "\n" + line, line + "\n" + base[2], base[3] + " " + base[4]]
    out += [line + "\n" + sentence(g, 40) for _ in range(copies)]
    out += [" ".join([sentence(g, 3000), line]), "日本 " * 30, "naïve café x " * 5]
    return out


def table(spark, values, ids=None):
    rows = [
        (ids[i] if ids else i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or ""))
        for i, t in enumerate(values)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(df, *names):
    """The documents with more columns, named like results, of other types."""
    return df.withColumns({n: F.lit("taken") for n in names})


def same_without_order(df):
    return sorted(map(repr, df.collect()))
