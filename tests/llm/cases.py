"""Rows that every operator must handle: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

LONG = " ".join(f"w{i % 977}{'x' * (i % 7)}" for i in range(30_000))


def awkward(extra: str) -> tuple[list[tuple], str]:
    """Rows and schema of a documents table with a clashing column ``extra``."""
    rng = random.Random(11)
    prose = " ".join(rng.choice(["alpha", "beta", "Gamma", "Δelta", "ñandú", "#tag", "5|6"]) + str(rng.randrange(60)) for _ in range(130))
    texts = [
        (1, prose), (2, prose), (3, prose + " tail"), (4, ""), (5, None), (6, " \n\t "), (7, LONG), (8, "one two"), (9, "one two"),
        (None, prose), (10, "!!! ??? 123"), (10, "!!! ??? 123"), (11, "日本語 テキスト\nzwei\n\nzwei"), (12, "a\x1cb \x85 c\r\nd <|endoftext|> e"),
    ]
    rows = [(i, t, None if k % 3 else "en", "src", None if t is None else len(t), f"v{k}") for k, (i, t) in enumerate(texts)]
    return rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra} string"
