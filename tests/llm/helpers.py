"""Small document tables for the tests of the training-data operators."""

import random

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "size int, node string, kept string, n int, u int, _x string, component_id int")

WORDS = "alpha beta gamma delta river stone cloud winter summer paper green silver table window garden music".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ing", "ed"]) for _ in range(n))


def docs(spark, rows):
    """rows of (doc_id, text[, lang[, source]]); every table has extra columns with clashing names."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *("en", "s")[len(r) - 2:]) if len(r) < 4 else r
        full.append((doc_id, text, lang, source, None if text is None else len(text),
                     7, "x", "y", 1, 2, "z", 3))
    return spark.createDataFrame(full, SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
