"""Small corpora that several test modules share."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside.
CLASHING = ["row", "kept", "copies", "size", "node", "group", "chunk", "bucket", "shard", "slot", "rate", "_text", "n_words"]


def documents(spark, rows):
    """Rows (doc_id, text, lang, source) as documents."""
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    long = " ".join(f"word{i % 977} tail{i % 13}" for i in range(30_000))
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n ", None, None),
        (4, "one", "en", None),
        (5, long, "en", "b"),
        (6, "same text of two rows, repeated as it is\n" * 9, "de", "b"),
        (6, "same text of two rows, repeated as it is\n" * 9, "de", "b"),
        (7, "same text of two rows, repeated as it is\n" * 9, "de", "b"),
        (None, "same text of two rows, repeated as it is\n" * 9, "de", "b"),
        (None, None, None, None),
        (8, "é▁ 𐍈 ###\x00 THE the The", "xx", "c"),
    ]


def random_texts(seed: int, count: int, vocabulary: int = 60) -> list[str]:
    """Texts of which some are copies of others, with a few words changed or a passage shared."""
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdefgh')}{rng.randrange(10 ** rng.randrange(1, 4))}é"[: rng.randrange(1, 6)] for _ in range(vocabulary)]
    passage = " ".join(rng.choice(words) for _ in range(25))
    texts: list[str] = []
    for _ in range(count):
        kind = rng.random()
        if texts and kind < 0.35:
            copied = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(4)):
                copied[rng.randrange(len(copied))] = rng.choice(words)
            texts.append(" ".join(copied))
        else:
            own = [rng.choice(words) for _ in range(rng.randrange(1, 90))]
            texts.append(" ".join([*own, passage, *own[:5]] if kind > 0.8 else own))
    return texts
