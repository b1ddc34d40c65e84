"""Texts that the tests of this folder share."""

from __future__ import annotations

import random


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, a very long one, copies, near copies, repeated rows, a shared passage."""
    rng = random.Random(11)
    base, passage = sentence(rng, 200), sentence(rng, 60)
    words = base.split(" ")
    near = " ".join(words[:100] + ["changed"] + words[101:])
    lines = "\n".join(sentence(rng, 8) for _ in range(12))
    rows: list[tuple[int | None, str | None]] = [
        (0, None),
        (1, ""),
        (2, " \t\n "),
        (3, "one"),
        (4, "two words"),
        (5, base),
        (6, base),
        (7, near),
        (8, sentence(rng, 50) + " " + passage + " " + sentence(rng, 50)),
        (9, passage + " " + sentence(rng, 80)),
        (10, lines),
        (11, sentence(rng, 9) + "\n" + lines + "\n" + sentence(rng, 7)),
        (12, sentence(rng, 30_000)),
        (12, "same id, other text"),
        (13, "same row " * 30),
        (13, "same row " * 30),
        (None, "text without an id " + sentence(rng, 40)),
        (None, None),
        (14, "ÄÖÜ ñandú 　 1234 don't <|endoftext|> 🙂🙂\r\n\r\n  x"),
        (15, "x" * 50_000),
    ]
    return rows + [(20 + i, sentence(rng, 70)) for i in range(10)]
