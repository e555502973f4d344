"""Small inputs that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random
import re

LOWER = {c: c + 32 for c in range(65, 91)}
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()


def spaced(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 60)) for _ in range(n))


def copy_of(text, seed, changes):
    r = random.Random(seed)
    w = text.split(" ")
    for _ in range(changes):
        w[r.randrange(len(w))] = "changed" + str(r.randint(0, 999))
    return " ".join(w)


EDGE = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One two THREE four"), (6, "one two three four five"),
    (7, "Ünïcödé wörds — “quoted” 日本語 テスト nbsp em  double  spaces \x1c\x85 odd"), (8, "<|endoftext|> inside <|startoftext|> a text's don't"),
    (9, "word " * 3000), (10, prose(1, 9000)), (11, prose(2, 120)), (12, prose(2, 120)), (13, copy_of(prose(2, 120), 3, 2)), (None, "a text without an id"),
    (15, "same row"), (15, "same row"), (16, "x" * 5000), (17, "tab\tnew\nline\r\nend\x0b\x0c."), (18, "😀 emoji 👩‍👩‍👧 é combining"),
]


def documents(spark, rows=None, extra=True):
    rows = EDGE if rows is None else rows
    df = spark.createDataFrame([(i, t, "en", None if i is None else f"src{i % 3}", None if t is None else len(t)) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    if extra:  # names that operators use inside
        from pyspark.sql import functions as F
        for c in ("id", "n", "key", "segment", "row", "hub", "length", "part", "score", "y"):
            df = df.withColumn(c, F.lit("extra"))
    return df
