import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, n_words int, stats int, members int, uses int, row int, g int"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = "on er th nd re ing ha ou es at en ti or st an".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and blank texts, repeated rows, ties, near
    copies, a very long text, odd characters; extra columns with names that
    the operators use themselves."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [(1, base), (2, base), (3, " ".join(near)), (4, base.upper()), (5, None), (6, ""), (7, " \t\n\x0b\x0c\r"), (8, "one"),
             (9, "one two three"), (10, "Über ÉTÉ   x́ \U0001f600 <|endoftext|> it's ''"), (11, prose(2, 20000)),
             (12, "w" * 50000), (13, "same words " * 300), (14, prose(3, 200) + " " + base), (None, prose(4, 90)),
             (None, base), (15, prose(5, 100)), (15, prose(5, 100)), (15, prose(6, 60)),
             (16, "\n".join([prose(7, 30)] * 3 + ["", prose(8, 30)])), (17, " ".join(w + "###" for w in prose(9, 80).split()))]
    texts += [(100 + i, prose(100 + i, 60 + i)) for i in range(40)]
    return [(i, t, (None, "en", "de")[k % 3], (None, "a", "b", "ü")[k % 4], None, "x", 1, 2, 3, 4, 5, 6)
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
