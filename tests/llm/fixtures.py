"""Small document tables with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the of and to in a is that for it with was on be by this are from at or an river stone market letter garden winter evening".split()
DE = "der die und das ist nicht ein eine mit von zu den auf für im dem sich werk haus garten abend straße".split()


def prose(rng, words, vocabulary=EN):
    out = []
    for k in range(words):
        w = rng.choice(vocabulary) if rng.random() < 0.5 else "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(4, 9)))
        out.append(w.capitalize() if k % 12 == 0 else w + "." if k % 12 == 11 else w)
    return " ".join(out)


def rows():
    """(doc_id, text, lang, source, n_chars): clean texts, copies, near copies, shared passages, junk, NULLs, empty and long ones."""
    rng = random.Random(5)
    out = []

    def add(text, lang="en", doc_id=...):
        out.append((len(out) if doc_id is ... else doc_id, text, lang, "src0", None if text is None else len(text)))

    base = [prose(rng, rng.randint(60, 200)) for _ in range(30)]
    for b in base:
        add(b)
    for _ in range(10):
        add(prose(rng, 90, DE), "de")
    for _ in range(8):
        add(base[3])  # exact copies
    ws = base[4].split(" ")
    for k in range(6):
        add(" ".join(ws[:k * 5] + ["Changed"] + ws[k * 5 + 1:]))  # near copies
    shared = prose(rng, 60)
    for _ in range(4):
        add(prose(rng, 50) + "\n" + shared + "\n" + prose(rng, 40))
    add(" ".join(["again"] * 120))
    add("line of text here\n" * 40)
    add(" ".join(w + "###" for w in prose(rng, 80).split()))
    add(prose(rng, 80).upper().replace(" ", "!! "))
    add(prose(rng, 20_000))  # very long
    add("x" * 50_000)  # one very long word
    add("7" * 30_000 + " 1.2.3." + "4" * 9_000)
    add(None, None)
    add("", "en")
    add(" \n\t ", None)
    add("one", "en")
    add("mail me: jo.doe@mail.example.com, or +1 (017) 555-7713, from 10.0.0.256 and 10.0.0.25;", "en")
    add('card 4539 1488 0343 6467 and key = "908038b7daaf91e730d2f908038b7daaf91e730d" end', "en")
    add("don't  stop\r\n'tis café   naïve 日本 <|endoftext|> \U0001f600 é", "fr")
    add(base[0], "en", doc_id=None)  # no id
    add(base[1], "en", doc_id=1)  # repeated row
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def with_extra(df, *names):
    """Extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    for n in names:
        df = df.withColumn(n, F.lit("mine"))
    return df


def as_set(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
