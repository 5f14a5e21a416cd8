"""Small tables with nulls, empty and long texts, ties, repeated rows and columns of clashing names."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot string, size string, " + \
    "rejected string, language string, n_words string, turn string, bucket string, row string, words string"
CLASH = ("x",) * 10

SYLLABLES = {"en": ["the", "ing", "er", "on", "wh"], "fr": ["eau", "que", "ou", "é", "le"]}


def prose(rng: random.Random, lang: str, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))).capitalize() if rng.random() < 0.1
                    else "".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


def documents(spark, seed: int = 3, rows: int = 60):
    rng = random.Random(seed)
    found = []
    for i in range(rows):
        lang = "fr" if i % 3 == 0 else "en"
        found.append((i, prose(rng, lang, rng.randint(1, 90)), lang, ["b", "a", None, "hot"][min(3, rng.randrange(6))]))
    base = found[1][1] + " " + prose(rng, "en", 60)
    found += [(100 + i, base, "en", "hot") for i in range(20)]  # copies
    for i in range(20):  # near copies
        words = base.split(" ")
        words[rng.randrange(len(words))] = f"changed{i}"
        found.append((200 + i, " ".join(words), "en", "hot"))
    found += [
        (300, None, "en", "a"), (301, "", None, None), (302, " \t\n\x0b", "fr", "a"), (None, "no id here", "en", "b"),
        (None, None, None, None), (303, "x" * 70_000, "en", "a"), (304, prose(rng, "en", 9000), "en", "a"),
        (305, "12 34 ... !!", None, "b"), (306, "ÉCOLE Écoute\u00a0là 😀 ok", "fr", "b"),
    ]
    found += [(307, "the same row twice over and over", "en", "b")] * 3
    return spark.createDataFrame([(*r, None, *CLASH) for r in found], DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]
