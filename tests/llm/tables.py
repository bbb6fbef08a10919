"""Small tables with the rows that usually break things."""
import random

LONG = " ".join(random.Random(3).choice(["alpha", "beta", "gamma", "delta", "épsilon"]) + str(i % 977) for i in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while twelve other animals look on from the far side of a very wide river"

# doc_id, text, lang, source, n_chars and columns that outputs or helpers use as well
ODD = [
    (1, None, "en", "a", 0, 1, "x", 5), (2, "", None, None, 0, 2, "x", 5), (3, " \t\n", "en", "a", 3, 3, None, 5),
    (4, "one", "en", "b", 3, None, "x", 5), (5, "one", "de", "b", 3, 5, "y", 5), (6, "ONE", "de", "b", 3, 6, "y", None),
    (7, LONG, "en", "a", len(LONG), 7, "y", 5), (8, LONG + " more", "en", "c", None, 8, "y", 5), (7, LONG, "en", "a", len(LONG), 7, "y", 5),
    (9, PASSAGE + " first end", "en", "a", 10, 9, "y", 5), (10, "other start " + PASSAGE, "en", None, 10, 9, "y", 5),
    (11, PASSAGE + PASSAGE, "fr", "d", 10, 9, "y", 5), (None, PASSAGE, "fr", "d", 10, 9, "y", 5), (12, "añb c 💡 d", "es", "a", 9, 1, "y", 5),
    (13, "1234 5678", None, "a", 9, 1, "y", 5), (None, None, None, None, None, None, None, None), (-4, "x y", "en", "a", 3, 1, "y", 5),
]


def odd_docs(spark):
    return spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, node string, "
                                      "size bigint").repartition(3)
