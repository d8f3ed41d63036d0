"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

SYLLABLES = "an the re in of er to ed es on ti st ha en ou nd ly ing".split()


def sentence(rng: random.Random, words: int) -> str:
    made = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words)]
    return " ".join(made).capitalize() + "."


def prose(rng: random.Random, lines: int = 6) -> str:
    return "\n".join(sentence(rng, rng.randint(8, 25)) for _ in range(lines))


def rows(seed: int = 7) -> list[tuple]:
    """Documents with copies, near copies, nulls, blanks, repeated rows and a long text."""
    rng = random.Random(seed)
    out: list[tuple] = []
    for k in range(40):
        out.append((k, prose(rng), rng.choice(["en", "de"]), f"s{k % 3}", 1))
    out += [(100 + k, out[3][1], "en", "s0", 1) for k in range(12)]
    for k in range(12):
        words = out[5][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        out.append((200 + k, " ".join(words), "en", "s1", 1))
    out += [
        (300, None, "en", "s0", None),
        (301, "", "en", "s0", 0),
        (302, " \n\t ", None, "s0", 4),
        (303, "one", "en", None, 3),
        (304, "ONE", "en", "s2", 3),
        (305, "Ünï çødé 𝄞 текст     中文", "xx", "s2", 1),
        (None, prose(rng), "en", "s0", 1),
        (None, None, None, None, None),
        (306, prose(rng, 1500), "en", "s1", 1),
        out[7],
        out[7],
        (8, prose(rng), "en", "s1", 1),
    ]
    return out


def documents(spark: SparkSession, some: list[tuple] | None = None, parts: int = 3) -> DataFrame:
    """The rows as a table; extra columns have names that operators use as well."""
    frame = spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(parts)
    for name in ("kept", "n_words", "words", "bucket", "leaks", "lines", "_m", "n_tokens", "host"):
        frame = frame.selectExpr("*", f"'extra' AS {name}")
    return frame
