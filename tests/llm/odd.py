"""Documents with nulls, empty and long texts, ties, copies, repeated rows and columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, score int, _key int, rank int"


def words(n, seed, pool=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


PASSAGE = " ".join(words(60, 1))
LONG = " ".join(words(6_000, 2, 5_000))
NEAR = words(300, 3, 2_000)


def texts():
    copy = " ".join(words(150, 4))
    return [
        (1, copy), (2, None), (3, ""), (4, "   \t\n "), (None, copy), (5, LONG), (5, LONG), (6, "One"), (7, "one"),
        (8, PASSAGE + " " + " ".join(words(80, 5))), (9, " ".join(words(70, 6)) + "\n" + PASSAGE), (10, copy), (11, copy.upper()),
        (12, " ".join(NEAR)), (13, " ".join([*NEAR[:-1], "other"])), (14, "x " * 900), (15, "é ü 漢字 " * 60), (None, None),
        (16, "CC-BY and cc by; All rights reserved. GNU General Public License"), (17, "a" * 2_000), (18, LONG[:20_000] + "!"),
    ]


def rows():
    sources = ["b", None, "a", "é", "B"]
    return [(d, t, None if i % 4 == 0 else "en", sources[i % 5], None if t is None else len(t), i, "x", None, 1, 2) for i, (d, t) in enumerate(texts())]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3, "size")


def none(spark):
    return spark.createDataFrame([], SCHEMA)
