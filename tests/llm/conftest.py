import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents():
    """Some 120 small texts: plain ones, exact and near copies, shared passages, empty and null ones."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(2, 8))) for _ in range(600)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    texts = [prose(rng.choice([1, 3, 5, 12, 40, 90, 200])) for _ in range(60)]
    texts += [texts[k] for k in range(10)]
    for k in range(20):
        words = prose(rng.choice([30, 120, 300])).split()
        texts.append(" ".join(words))
        for j in (3, 17):
            words[j] = "changed"
        texts.append(" ".join(words))
        if k % 2:
            words[len(words) // 2] = "again"
            texts.append(" ".join(words))
    texts += [prose(20) + "\n" + passage + "\n" + prose(15) for _ in range(6)]
    texts += ["", None, " \n\t ", "Word", "word WORD wOrd", "aaaa " * 80, "x" * 700, "ééé" * 100, "A line.\nA line.\n\nAnother, longer line."]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None]), None if t is None else len(t))
            for i, t in enumerate(texts)]


@pytest.fixture
def frame(spark, documents):
    return spark.createDataFrame(documents, COLUMNS).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
