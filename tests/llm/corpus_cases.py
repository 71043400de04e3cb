"""Documents for the tests of the corpus operators."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, w int, whole_row int, score string, node int, text_key int, range int"


def text_of(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def docs_frame(spark, rows):
    """(doc_id, text, lang, source) with further columns whose names operators use themselves."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "s", 1, 2, "x", 3, 4, 5) for r in rows], SCHEMA)


EDGES = [
    (0, text_of(1, 300), "en", "a"),
    (1, text_of(1, 300), "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n\x0b\x0c\r ", "de", None),
    (5, text_of(2, 30_000, 5000), None, None),
    (None, text_of(3, 120), "en", "a"),
    (None, None, None, None),
    (7, text_of(4, 90), "fr", "b"),
    (7, text_of(4, 90), "fr", "b"),
    (8, "one", "en", "a"),
    (9, "x" * 20_000, "en", "b"),
]
