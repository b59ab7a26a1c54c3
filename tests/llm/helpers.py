"""Small document tables with every awkward case the operators define."""

import random

LONG = "lorem ipsum dolor sit amet " * 8000  # 216,000 characters

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "hits string, score string, norm string, h string, salt int, key string, block int, fp string")


def documents(spark, rows, schema=SCHEMA):
    """rows: (doc_id, text, lang); further columns clash with names used inside the operators."""
    full = [(i, t, g, None, None, "x", "x", "x", "x", 1, "x", 2, "x") for i, t, g in rows]
    return spark.createDataFrame(full, schema)


def awkward(spark):
    return documents(spark, [
        (1, "Alpha beta gamma delta", "en"), (2, "alpha BETA gamma delta", "en"), (3, None, None), (4, "", "en"),
        (5, "", None), (6, LONG, "en"), (7, LONG, "en"), (8, "été ÉTÉ 🙂 ñ", "fr"), (8, "été ÉTÉ 🙂 ñ", "fr"),
        (9, "   \n\t ", "de"), (None, "Alpha beta gamma delta", "en"), (None, None, None), (10, "x", "en"), (-3, "x", "en"),
    ])


def empty(spark):
    return documents(spark, [])


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    stems = ["".join(random.Random(f"w{i}").choices("abcdefghijklmnopqrstuvwxyz", k=2 + i % 7)) for i in range(vocabulary)]
    return [stems[min(int(rng.expovariate(0.02)), vocabulary - 1)] for _ in range(n)]
