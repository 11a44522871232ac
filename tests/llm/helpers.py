"""Small documents that hold every awkward case, with columns whose names clash with results."""

from __future__ import annotations

import random

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, kept string, shard string, size string, words string, fp string"


def prose(seed: int, count: int, vocabulary: int = 4000) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary):x}q" for _ in range(count))


def awkward(spark):
    """Null, empty, blank, one-word, very long and repeated texts; null ids, sources and languages."""
    base = prose(1, 300)
    rows = [
        (0, base, "en", "a"),
        (1, base, "en", "a"),
        (1, base, "en", "a"),
        (2, base.replace("q w", "q  w", 3) + " tail", "en", "b"),
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, " \t\n ", "de", None),
        (6, "word", "de", "c"),
        (7, prose(7, 60_000), "en", "a"),
        (8, "é ü ñ 　 x\x1fy 漢字 🙂 \x85end", "fr", "c"),
        (None, prose(9, 80), None, "a"),
        (None, None, None, None),
        (11, " ".join(["same"] * 500), "en", "a"),
        (12, prose(12, 120) + "\n" + prose(1, 300), "en", "b"),
    ]
    return spark.createDataFrame([(i, t, lang, s, 0, "k", "s", "z", "w", "f") for i, t, lang, s in rows], CLASHING)


def nothing(spark):
    return spark.createDataFrame([], CLASHING)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
