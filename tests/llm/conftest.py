"""Small tables with the awkward cases every operator must answer: nulls in
any column, empty and long texts, repeated rows, ties and extra columns whose
names clash with the operators' own."""

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n long, kept boolean, spans string, g long, node string, score double")


def words(rng, n, vocab):
    return " ".join(rng.choice(vocab) for _ in range(n))


def rows():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 8))) for _ in range(600)]
    passage = words(rng, 90, vocab)
    base = words(rng, 120, vocab)
    out = []

    def add(text, lang="en", source="s1", doc_id=True):
        out.append((len(out) if doc_id is True else doc_id, text, lang, source, None if text is None else len(text),
                    1, True, "x", 2, "y", 0.5))

    for _ in range(12):
        add(words(rng, rng.randint(40, 150), vocab))
    add(None)
    add("")
    add("   \n\t ")
    add("Word")
    add("two words")
    add(base)
    add(base)  # exact copy
    near = base.split()
    near[40] = "changed"
    add(" ".join(near))
    add(words(rng, 30, vocab) + " " + passage + " " + words(rng, 30, vocab), lang=None)
    add(words(rng, 20, vocab) + " " + passage, source=None)
    add(passage + " " + words(rng, 25, vocab))
    add("Ünï çödé — 北京 Москва \u0085 " + passage.upper())
    add(words(rng, 20_000, vocab))  # long
    add("x" * 70_000)  # one long word
    add("ab " * 900)  # periodic
    add("mail a.b+c@d-e.org now! +1 (839) 555-1724, 10.0.0.1 4111 1111 1111 1111 token = \"9c8b45435718dcc700c184a7e30b\"")
    add(out[3][1], doc_id=3)  # a repeated row
    add("another text under a used id " + words(rng, 30, vocab), doc_id=5)
    add(base + " tail", doc_id=None)
    return out


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def pairs():
    """(doc_id, text) of the fixture."""
    return [(r[0], r[1]) for r in rows()]


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def items(spark):
    texts = {r[0]: r[1] for r in rows() if r[0] is not None}
    ws = texts[20].split()
    return spark.createDataFrame(
        [(1, " ".join(ws[40:70])), (2, "two words"), (3, None), (4, "..."), (5, "never seen anywhere at all"),
         (None, "Word"), (1, " ".join(ws[70:75]))], "item_id long, text string")
