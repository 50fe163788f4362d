import random

import pytest

WORDS = [a + b + c for a in ("ka", "lo", "mi", "tu", "re") for b in ("n", "st", "", "rd") for c in ("a", "en", "is")]


def prose(rng: random.Random, n: int) -> str:
    """n invented words in sentences and lines."""
    out = []
    for i in range(n):
        w = rng.choice(WORDS) + rng.choice(WORDS)
        out.append(w.capitalize() if i % 9 == 0 else w)
        if i % 9 == 8:
            out[-1] += ".\n" if i % 27 == 26 else "."
    return " ".join(out)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Rows with NULLs, empty and very long texts, ties and repeated rows, and extra
    columns whose names clash with columns the operators use themselves."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.replace(base.split()[60], "changed", 1)
    long = prose(rng, 40_000)
    texts = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, "two words"), (7, "TWO words"),
             (8, long), (9, long + " end"), (10, " \n\t "), (11, "x"), (12, "ünï " * 30), (12, "ünï " * 30),
             (13, base), (13, near), (None, "no id"), (None, base), (14, "aaaa" * 300), (15, "\n".join(["line"] * 50))]
    texts += [(100 + i, "copied text of a hot group") for i in range(40)]
    rows = [(i, t, "src", "x", 1, 2, 3, 4) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, sha string, id int, "
                                       "uid int, row int, `a.b` int").repartition(3)


@pytest.fixture()
def no_docs(edge_docs):
    return edge_docs.limit(0)


def rows_of(df):
    return [r.asDict() for r in df.collect()]
