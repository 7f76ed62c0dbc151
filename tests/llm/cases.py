"""Small document tables with planted cases and hostile rows."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use inside; they must pass or be ignored without a crash.
CLASHING = (
    "digest content salt keep_id kept id bucket bands signature label pivot component a b n ta tb "
    "virtual_slot shard slot nth first pack row ids sequence_id offset gram score languages start "
    "length d1 d2 run u unit part canon host path rule html_ prob"
).split()

WORDS = {
    "en": "the of and to in that it is was for with as his on be at by had not are but from or have an they".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
    "fr": "le de la et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont".split(),
}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) + str(rng.randint(0, 40)) * rng.randint(0, 1) for _ in range(n))


def hostile(seed: int = 0) -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    rng = random.Random(seed)
    base = sentence(rng, "en", 120)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base, "en", "s", 1),
        (2, base, "en", "s", 1),
        (2, base, "en", "s", 1),  # a repeated row
        (3, " ".join(near), None, None, None),
        (4, None, "en", "s", 1),
        (5, "", None, "s", 1),
        (6, " \t\n ", "en", None, 1),
        (None, base, "en", "s", None),
        (None, None, None, None, None),
        (7, "Two words", "en", "s", 1),
        (8, "two WORDS", "en", "s", 1),
        (9, sentence(rng, "de", 60_000), "de", "s", 1),  # very long
        (10, "12345 !!! 678", "en", "s", 1),
        (11, "ÄÖ ü ß \U0001f600 <|endoftext|> ok", "de", "s", 1),
        (12, sentence(rng, "fr", 80), "fr", "s", 1),
    ]


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHING)) if clash else df
