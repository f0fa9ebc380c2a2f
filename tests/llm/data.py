"""Small documents with the cases every operator has to bear."""

import random

WORDS = "the of and to in that was for on are with his they at be this from have or one had by word".split()


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def documents(spark, rows=None, extra: bool = True):
    """Null, empty, blank, long, repeated and copied texts; extra columns with names used inside."""
    if rows is None:
        long = sentence(1, 3000)
        base = sentence(2, 120)
        rows = [
            (1, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", "b"), (4, None, "en", None),
            (5, "", None, "a"), (6, " \t\n ", "de", "b"), (7, long, "en", "a"), (8, long + "\n" + long, "en", None),
            (9, "été ñandú 漢字 🙂 " * 30, "fr", "c"), (9, "été ñandú 漢字 🙂 " * 30, "fr", "c"),
            (10, sentence(3, 60), None, "b"), (11, "ab" * 400, "en", "c"), (None, sentence(4, 50), "en", "a"),
            (12, "SHOUT!! $$$ ### " * 20, "en", "d"),
        ]
    schema = "doc_id long, text string, lang string, source string"
    frame = spark.createDataFrame(rows, schema)
    if extra:
        names = ["size", "row", "key", "node", "label", "base", "kept", "taken", "doc", "tie", "part", "n"]
        for i, name in enumerate(names):
            frame = frame.selectExpr("*", f"{i} AS {name}")
    return frame


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
