"""Made texts and the checks that several tests share."""

import random

SYLLABLES = "an er the in re ou ti on st ea ha ng de la mi so".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def text(rng, lines=4, n=12):
    return "\n".join(" ".join(words(rng, n)).capitalize() + "." for _ in range(lines))


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def rng(seed=0):
    return random.Random(seed)
