"""Fixtures of the training-data tests: awkward documents and an empty table, both with columns of clashing names."""

from __future__ import annotations

import random
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n int, h string, root int, payload string, found string, kind int, label int, near_key int"


def prose(seed: int, n: int, vocabulary: int = 300) -> str:
    r = random.Random(seed)
    words = [f"w{r.randrange(10**6)}" for _ in range(vocabulary)]
    return " ".join(r.choice(words) for _ in range(n))


def awkward() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    shared = prose(2, 90)
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one two three"), (8, "one two three"),
        (9, prose(3, 40) + "\n" + shared + "\n" + prose(4, 40)), (10, shared + " tail words here"), (11, prose(5, 30_000, 4000)), (None, prose(6, 50)), (None, None),
        (12, "Étion dans, çouelle ß ñ 日本語 текст́ é\n\n\nÉtion dans"), (13, "a" * 1500), (14, "same line here\n" * 60), (15, "\x00\x1f odd   space wide 's don't !!*** <|endoftext|>"),
        (16, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\n" + prose(7, 30)),
    ]


def frame(spark, rows):
    full = [(d, t, "en" if d and d % 2 else None, None, None, "x", 1, "y", 2, "z", "f", 9, 7, 3) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def ordered(df, *columns):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


def by_key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def shingle_counts(text: str, size: int = 5) -> Counter:
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()
