import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row int, key string, doc long, size string, part string, value double, w int, kind string, template string"
EXTRA = (7, "k", 8, "s", "p", 0.5, 3, "x", "t")


def as_documents(spark, pairs, sources=("a", "b", None)):
    """Documents with columns whose names the operators use themselves."""
    rows = [(i, t, "en", sources[n % len(sources)], None if t is None else len(t), *EXTRA) for n, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, COLUMNS)


def prose(rng, n):
    syllables = ["th", "on", "re", "ing", "ha", "st", "en", "ou", "ly", "er", "an", "ti", "ble", "wh", "é"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def pairs():
    """Texts with nulls, empty ones, copies, near copies, a shared passage, repeated rows and a very long one."""
    rng = random.Random(5)
    base, passage, long = prose(rng, 150), prose(rng, 60), prose(rng, 9000)
    near = base.split()
    near[70] = "changed"
    out = [(1, None), (2, ""), (3, base), (4, " ".join(near)), (5, base.upper()), (6, base), (6, base), (7, " \n\t "), (8, "one two"),
           (9, prose(rng, 40) + "\n" + passage + " " + prose(rng, 30)), (10, prose(rng, 25) + " " + passage + "\n" + prose(rng, 45)),
           (11, long), (12, long[:30_000] + prose(rng, 10)), (13, "ab" * 40), (14, "ab" * 90), (15, "éé é" * 30), (16, "one two"), (17, "a\x00b c")]
    return out + [(20 + i, prose(rng, 30 + i)) for i in range(12)]
