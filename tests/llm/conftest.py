import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, band int, kept string, component long, score double, row int"
)


def words(text):
    return WORD.findall(text or "")


def prose(seed, n=60):
    """n words that depend on the seed."""
    state, out = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append("".join("bcdfglmnprstaeiou"[(state >> k) % 17] for k in (3, 7, 11, 15, 19)))
    return " ".join(out)


def messy_rows():
    """Documents with every awkward value: (doc_id, text, lang)."""
    long = " ".join(prose(s, 40) for s in range(200))
    return [
        (1, prose(1), "en"),
        (2, prose(1), "en"),  # a copy
        (2, prose(1), "en"),  # the same row again
        (3, prose(1) + " tail", "de"),  # a near copy
        (4, None, "en"),
        (5, "", None),
        (6, " \t\n\v\f\r ", "fr"),
        (7, long, "de"),
        (8, "one two three", "en"),
        (9, "one two three", "en"),
        (None, prose(3), None),
        (None, None, "en"),
        (10, prose(4) + "\n" + prose(5) + "\n" + prose(4), "fr"),
        (11, "!!! 123 ...", "en"),
        (12, "é" * 3000, "fr"),
        (-5, prose(5), "de"),
        (13, "<|endoftext|> it's 'quoted' “so” ﬁne Ǆ 12.5% á​ b", "en"),
    ]


def frame(spark, rows):
    full = [(i, t, g, "s", len(t or ""), 7, 7, "x", 7, 0.5, 7) for i, t, g in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def messy(spark):
    return frame(spark, messy_rows()).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
