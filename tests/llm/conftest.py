import random

import pytest

# Names that the operators use themselves.
CLASHES = "id string, node string, n string, batch string, kept string, key string, part string, n_chars bigint"


@pytest.fixture(scope="session")
def prose():
    """Invented sentences of a few languages' frequent words."""
    words = {
        "en": "the of and to in is that for it with was on are this from".split(),
        "fr": "le la de et les des en un une du que est pour qui dans".split(),
    }

    def write(seed, count, lang="en"):
        rng = random.Random(seed)
        syllables = "er on an re he in ed nd ha at en es of or nt" if lang == "en" else "é ai ou eau ch qu oi è vi ment"
        made = lambda: "".join(rng.choices(syllables.split(), k=rng.randint(2, 4)))
        return " ".join(rng.choice(words[lang]) if rng.random() < 0.4 else made() for _ in range(count))

    return write


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) with extra columns of clashing names."""

    def make(rows):
        rows = [(i, text, *("x",) * 7, 0) for i, text in rows]
        return spark.createDataFrame(rows, f"doc_id bigint, text string, {CLASHES}")

    return make


@pytest.fixture
def odd(prose):
    """Null, empty, blank, long, repeated and equal texts, ties and a null id."""
    same = prose(1, 30)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, same), (4, same), (5, same.replace(" ", "  ")), (6, same + " "),
        (7, prose(2, 20_000)), (8, "one"), (9, "Two words"), (10, "ONE"), (None, same), (None, None), (11, "a" * 70_000),
        (12, "日本語 текст ß\x1c end"), (12, "another text of the same id"),
    ]
