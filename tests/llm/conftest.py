import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names the operators use inside.
CLASH = DOCS + ", key bigint, n int, start int, score double, row string, fp bigint, bucket string, kept boolean"


def make_rows(seed=3):
    """Texts with copies, near copies, shared passages, blanks, nulls, repeats and one long text."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéñß") for _ in range(r.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage, base = text(45), text(120).split(" ")
    rows = [None, "", "  \n\t ", "one", "Two words", text(200), text(3000), "x " * 90, "lo la " * 60 + passage]
    rows += [rows[5], rows[5].upper(), passage, text(30) + "\n" + passage + "\n" + text(30), text(25) + " " + passage]
    for i in range(6):
        copy = list(base)
        copy[10 * i + 3] = "edit%d" % i
        rows.append(" ".join(copy))
    rows += [" ".join(base[:90]), "a b c", "tab\tand\nline\r\nend", "😀 ok", rows[5]]
    return [(i * 3, t, None if i % 5 == 0 else "en", "s%d" % (i % 2), None if t is None else len(t)) for i, t in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark, rows):
    return spark.createDataFrame([(*r, 7, 1, 2, 0.5, "r", 9, "b", False) for r in rows], CLASH)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_ids(spark):
    """Null and repeated ids, equal rows."""
    t = " ".join("w%d" % i for i in range(60))
    return spark.createDataFrame([(None, t, None, None, None), (None, None, "en", "s", 0), (4, t, "en", "s", 1),
                                  (4, t, "en", "s", 1), (4, "other text", "en", "s", 1), (5, t + " tail", "en", "s", 1)], DOCS)
