import random

import pytest


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]


@pytest.fixture(scope="session")
def corpus(words):
    """(doc_id, text): prose, copies, near copies, nulls, empty, long, tied and repeated rows."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    rows = list(enumerate(texts))
    rows += [(100 + i, texts[i]) for i in range(8)]
    for i in range(8):
        w = texts[20 + i].split()
        w[len(w) // 2] = "changed"
        rows.append((200 + i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "a"), (304, "!!! ... ???"), (305, " ".join(texts) * 3)]
    rows += [(None, texts[3]), (None, None), (7, texts[7]), (7, texts[7])]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """Extra columns have the names that operators use themselves."""
    rows = [(d, t, f"lang{i % 3}", i, "x", 1.5) for i, (d, t) in enumerate(corpus)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, size int, lanes string, score double")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Tasks can import the package wherever the tests were started."""
    from riskweave.llm.ship import ship
    ship(spark)
