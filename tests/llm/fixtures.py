"""Small texts with the cases that operators must stand: nulls, empties, ties, copies, long words."""

import random


def texts(seed: int = 3, rows: int = 120) -> list:
    rng = random.Random(seed)
    words = [rng.choice("bcdfgh") + rng.choice("aeiouéß") + rng.choice(["", "n", "st", "rt"]) for _ in range(60)]

    def line(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [line(90) for _ in range(4)]
    found = []
    for _ in range(rows):
        parts = [line(rng.randint(1, 60)) for _ in range(rng.randint(1, 4))]
        if rng.random() < 0.4:
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        found.append(rng.choice(["\n", " ", "\n\n", ". "]).join(parts))
    near = found[5].split(" ")
    near[len(near) // 2] = "changed"
    found += [found[0], found[0], " ".join(near), None, "", " \n\t ", "one", "x" * 1500, "ab" * 700, "日本語 " * 40, "it's  a\x1c b <|endoftext|>"]
    return found


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, k long, n long, word string"


def documents(spark, values=None, extra=()):
    """The table, with a null id and a repeated row, columns with clashing names, in several partitions and files' order."""
    values = texts() if values is None else values
    rows = [(i, t, ["en", "de", None][i % 3], "s", len(t or ""), 0.5, "k", 1, 2, "w") for i, t in enumerate(values)]
    rows += [(None, "a text without an id", "en", None, None, None, None, None, None, None), *rows[:1], *extra]
    return spark.createDataFrame(rows, COLUMNS).repartition(3, "n_chars")


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
