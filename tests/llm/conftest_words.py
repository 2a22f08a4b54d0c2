"""A family of near copies around one text, and texts apart from it."""

import random


def family(n: int):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(400)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(400)] = word()
        rows.append((i, " ".join(copy)))
    return rows + [(n + i, " ".join(word() for _ in range(100))) for i in range(20)]
