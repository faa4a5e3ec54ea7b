"""Fixtures shared by the tests of the training-data operators."""

import random

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "la", "mu", "nu", "xi", "omikron", "pi"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


def edit(rng, text, share):
    w = text.split(" ")
    for i in range(len(w)):
        if rng.random() < share:
            w[i] = "x" + str(rng.randint(0, 9999))
    return " ".join(w)


def odd_documents(spark, extra=()):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows and clashing column names."""
    rng = random.Random(3)
    base = prose(rng, 120)
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "  \t\n ", None, None), (4, base, "en", "b"), (5, base, "en", "b"), (5, base, "en", "b"),
            (6, edit(rng, base, 0.01), "de", "b"), (7, edit(rng, base, 0.3), None, "c"), (None, base, "en", "a"), (8, "one", "en", "a"),
            (9, "One", "en", ""), (10, "one two", "fr", None), (11, prose(rng, 30_000), "en", "a"), (12, "é中 \U0001f600▁ x\x00y", "fr", "c"),
            (13, "w" * 50_000, "en", "c"), (14, "1234 5678 !!", "en", "a"), *extra]
    out = [(i, t, la, s, len(t or ""), -1, "clash", True) for i, t, la, s in rows]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long, size int, key string, kept boolean")


EMPTY = "doc_id long, text string, lang string, source string, n_chars long"
