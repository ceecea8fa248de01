import random

import pytest


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, short, empty and NULL ones, personal data and a long word."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(["th", "er", "on", "an", "ré", "in"]) for _ in range(
        rng.randint(1, 4))) for _ in range(300)]
    out = [None, "", "   ", "one two", "One  TWO", "a b c d e", "\n\t"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 90))] for _ in range(12)]
    for words in base:
        out += [" ".join(words)] * 2
        near = list(words)
        near[len(near) // 2] = "changed"
        out.append(" ".join(near))
        far = list(words)
        far[::4] = ["other"] * len(far[::4])
        out.append("\n".join([" ".join(far[:20]), " ".join(far[20:]), " ".join(far[:20])]))
    out += ["x" * 9000, " ".join(vocabulary * 20),
            "write to a.b@c.de_x@y.zz or +1 (988) 555-2485, 42.144.35.254 999.1.1.1 "
            "4041894974608795 1234567890123 😀 z@w.org", "# $ | < " * 30, "THE END!! " * 30]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents with extra columns, a NULL id and a repeated row."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, 0, 0, "x")
            for i, t in enumerate(texts)]
    rows += [(None, texts[-4], "en", "s1", 0, 0, "x"), rows[8]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long, size int, slot string").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("1 = 0")
