import random

import pytest

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, spans string, score int, "
    "fp string, h int, n int, queue int, kind string, email string, tie int, bits string, part int, code string"
)


def _row(doc_id, text, lang="en", source="s"):
    extra = ("r", None, 1, "f", 2, 3, 4, "k", "e@x.org", 5, None, 6, "c")
    return (doc_id, text, lang, source, None if text is None else len(text), *extra)


def make_texts(seed=3, n=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 8))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(70))
    texts = []
    for i in range(n):
        body = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 160)))
        if i % 4 == 0:
            body = f"{body} {passage} {body[:30]}"
        if i % 5 == 0 and texts:
            body = texts[rng.randrange(len(texts))]
        if i % 7 == 0:
            body += "\n" + body[:200] + " x@y.example.org +1 (555) 123-4567 4111 1111 1111 1111 10.0.0.1"
        texts.append(body)
    return texts


@pytest.fixture(scope="session")
def rows():
    """Documents with all that can go wrong, ids unique but for the last rows."""
    texts = make_texts()
    out = [_row(i, t, "en" if i % 2 else "de", f"s{i % 3}") for i, t in enumerate(texts)]
    out += [
        _row(100, None), _row(101, ""), _row(102, " \n\t "), _row(103, "1 2 3 !!"), _row(104, "a", None, None),
        _row(105, "ab " * 30_000), _row(106, "z" * 5_000), _row(None, "no id here at all", "en"),
    ]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def repeated(spark, rows):
    """The same with every third row twice, and one id with two texts."""
    return spark.createDataFrame(rows + rows[::3] + [_row(1, "another text of one")], COLUMNS).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def pairs(rows):
    return [(r[0], r[1]) for r in rows]
