import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pairwarden.llm.shipping import prepare  # noqa: E402

#: Names that operators use inside; extra columns of a table may be called so.
CLASHING = "rank own key fp bucket digest row mark line hashes lang rank_ text_ share n label"


def _prose(rng, words, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(words))


def make_rows(seed=3, n=120):
    """(doc_id, text) with copies, shared passages, repeats within a text, nulls, ties, odd characters."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passages = [_prose(rng, 40, vocabulary) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, " \n\t\n"), (3, "\n\n"), (None, passages[0]), (None, passages[0] + " x"),
            (5, "x" * 300), (6, "ab" * 200), (7, "x" * 300), (8, "\0" * 120), (9, "\0" * 119 + "\1"),
            (10, "ÄÖ ß 日本 語́ <|endoftext|> it's 12½")]
    for i in range(20, 20 + n):
        kind = rng.random()
        text = _prose(rng, rng.randint(1, 90), vocabulary)
        if kind < 0.3:
            text = text + rng.choice([" ", "\n"]) + rng.choice(passages) + "\n" + text[: rng.randint(0, 60)]
        elif kind < 0.45:
            text = rows[rng.randrange(12, len(rows))][1] if len(rows) > 12 else text
        elif kind < 0.55 and len(rows) > 12:
            old = rows[rng.randrange(12, len(rows))][1].split(" ")
            old[rng.randrange(len(old))] = "changed"
            text = " ".join(old)
        elif kind < 0.7:
            text += "\n  ALL Rights reserved \n" + rng.choice(["", "tail", "All rights RESERVED"])
        rows.append((i, text))
    rows += [rows[15], rows[15], (15, rows[20][1]), (16, rows[20][1].upper())]  # repeated rows, ties
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def shipped(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(shipped):
    def make(rows):
        names = CLASHING.split()
        schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)
        data = [(d, t, *["clash"] * len(names)) for d, t in rows]
        return shipped.createDataFrame(data, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def docs(make_docs, rows):
    return make_docs(rows)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])


def _plain(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture(scope="session")
def same():
    def check(frame, names, want):
        assert _plain(frame.select(*names).collect()) == _plain(want)

    return check
