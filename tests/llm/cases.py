"""Odd rows that every operator on documents must bear."""

ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "é ́x 日本語 😀 \x1c   ΣΑΣ"),
    (6, "a b c d e f g " * 3000),
    (7, "twice the same text, twice the same text"),
    (7, "twice the same text, twice the same text"),
    (7, "same id, other text"),
    (None, "no id at all but some words here"),
    (9, None, None, None),
]
