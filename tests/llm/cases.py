"""Small tables with the awkward cases, and brute-force forms of the rules."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, fp string, part int"


def words(text):
    return WORD.findall(text or "")


def passage(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def documents():
    """Nulls in every column, empty and long texts, ties, repeated rows,
    copies, a shared passage, white space of all kinds, and extra columns
    whose names operators use themselves."""
    shared = passage("shared", 60)
    long = " ".join(f"w{i % 997}x{i % 89}" for i in range(9000))
    texts = [
        (1, passage("a", 40) + " " + shared + "\n" + passage("b", 30), "s1"),
        (2, shared + " " + passage("c", 25), "s2"),
        (3, passage("a", 40) + " " + shared + "\n" + passage("b", 30), "s1"),
        (4, None, "s1"),
        (5, "", None),
        (6, " \t\r\n\v\f ", "s3"),
        (7, "one", "s3"),
        (8, "two words", None),
        (9, long, "s1"),
        (10, "A B c Été 中文 \U0001f600 <|endoftext|> x", "é"),
        (11, passage("d", 19), "s2"),
        (12, passage("e", 20) + " " + passage("e", 20), "s2"),
        (12, passage("e", 20) + " " + passage("e", 20), "s2"),
        (13, "same id, first text " + passage("f", 30), "s4"),
        (13, "same id, other text " + passage("g", 30), "s4"),
        (None, shared, "s5"),
        (None, passage("h", 30), None),
        (20, "x " * 300, "s6"),
    ]
    return [(i, t, None if n % 5 == 0 else "en", s, None if n % 3 == 0 else len(t or ""), n, "own", 7)
            for n, (i, t, s) in enumerate(texts)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def removed_words(rows):
    """Marks of removed words for rows of (order, text); rows of equal order
    and text are one document."""
    first = {}
    for order, text in rows:
        w = words(text)
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            first[key] = min(first.get(key, (order, k)), (order, k))
    out = []
    for order, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if first[tuple(w[k:k + 20])] < (order, k):
                gone[k:k + 20] = [True] * 20
        out.append(gone)
    return out
