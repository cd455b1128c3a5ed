"""Frames with everything that may be odd about documents."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and river stone letter market window garden answer paper winter summer bridge silver copper forest island".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = [r.choice(WORDS) + r.choice(["", "", "s", "ing", "ed", "er"]) for _ in range(n)]
    return ". ".join(" ".join(words[i:i + 12]).capitalize() for i in range(0, n, 12)) + "."


def documents(spark, *rows):
    """Rows of (doc_id, text); two extra columns clash with names that operators add."""
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return frame.selectExpr("*", "1 AS spans", "'x' AS kept", "2 AS ids", "0.5D AS quality", "'n' AS node", "3 AS votes")


LONG = prose(1, 20_000)
ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, LONG), (5, prose(2, 80)), (6, prose(2, 80)), (6, prose(2, 80)),
    (None, prose(3, 70)), (None, prose(3, 70)), (7, "x" * 50_000), (8, "naïve ½ ١٢ 中文 <|endoftext|> é z\x1cq"), (9, prose(2, 40) + " " + prose(2, 80)),
]
