import random

import pytest

WORDS = "the of an ther ing tion eres and shen whor blea entis oner athe resh".split()


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", ".", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with nulls, empty and odd texts, copies, near copies, shared passages and a long text."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(["the", "an", "or", "st", "re", "bl", "ou", "é", "in"]) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    text = lambda n: prose(rng, n, vocabulary)
    passage, base = text(60), text(300).split(" ")
    rows = [(i, text(rng.randint(1, 200))) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(5)]  # copies
    for i in range(8):  # near copies
        w = list(base)
        for _ in range(i):
            w[rng.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, f"{text(30)} {passage} {text(25)}") for i in range(4)]
    rows += [(400, None), (401, ""), (402, "  \n\t "), (403, "12 34 -- !!"), (404, "One two"), (405, "one TWO"), (406, "  lead  double\u00a0space "),
             (407, "é" * 300), (408, "a" * 700), (409, text(6000)), (410, "one two three four"), (None, text(40)), (7, rows[7][1]), (7, "other text")]
    return rows


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with columns whose names operators use themselves."""
    rows = [(i, t, "en", "src", 1, 0.5, "x", 7, 8, "k") for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, "
                                       "component string, chunk int, piece int, tkey string").repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="session")
def split_words():
    return lambda text: (text or "").encode().translate(LOWER).split()
