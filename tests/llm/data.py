"""Small tables with nulls, empties, repeats, ties and columns whose names clash with an operator's own."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, seed, alphabet="the of and to in is it was for on are as with his they at be this from".split()):
    r = random.Random(seed)
    return " ".join(r.choice(alphabet) + r.choice(["", "", "er", "ing", "ly", str(r.randrange(50))]) for _ in range(n))


def edge_docs(spark, extra=""):
    rows = [
        (1, prose(40, 1), "en", "a", 1), (2, prose(40, 1), "en", "a", 1), (2, prose(40, 1), "en", "a", 1), (3, None, None, None, None),
        (4, "", "en", "b", 0), (None, prose(30, 2), None, "b", 5), (5, " \t\n ", "de", None, 3), (6, "One  two", "de", "", 8), (7, "one two", "de", "c", 7),
        (8, prose(30_000, 3), "en", "c", 9), (9, prose(39, 1), "xx", "c", 1), (-3, "é ü 漢字 😀 x", "fr", "b", 3),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
