"""Small documents with every awkward case, and a frame that holds them with
extra columns whose names clash with the operators' own."""
from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n long, key string, id string, size int, label long, seed long, fp long, component string")


def frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    data = []
    for r in rows:
        doc_id, text, lang = (*r, "en")[:3]
        data.append((doc_id, text, lang, "s", None if text is None else len(text), 1, "k", "i", 2, 3, 4, 5, "c"))
    return spark.createDataFrame(data, SCHEMA)


def prose(rng: random.Random, n: int, pool: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t \n"), (4, "x"), (5, "x"), (6, "Hello, World! it's <|endoftext|> 'll we'll"),
    (7, "日本語 テスト　ÀÉÎ ß İstanbul ΣΑΣ \x1c \x85 \xa0 z"), (8, "a" * 5000), (8, "a" * 5000),
    (9, "ab " * 20000), (None, "no id"), (None, None), (10, "😀👍🏽 zero​width\r\nline"),
]
