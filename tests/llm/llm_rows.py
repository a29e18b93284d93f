"""Small tables that hold every odd case the operators must take; test modules import the fixtures."""
import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, size bigint, "
          "uid string, row_key string, failed_bits string, kept string, spans string, words string")


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_texts():
    """Texts: NULL, empty, blank, short, long, copies, near copies, a shared passage, non-ASCII."""
    rng = random.Random(7)
    passage = " ".join(words(rng, 60))
    base = words(rng, 120)
    near = list(base)
    near[60] = "changed"
    return [None, "", " \t\n ", "one", "a b c d", "a b c d e", " ".join(base), " ".join(base), " ".join(near),
            " ".join(words(rng, 40)) + " " + passage + " " + " ".join(words(rng, 40)),
            " ".join(words(rng, 50)) + "\n" + passage, "Straße ünd Ñandú 😀 " * 30, "x" * 700, "ab" * 400,
            "\n".join(["same line here again"] * 12), "Word! " * 300, " ".join(words(rng, 20_000, 5000)),
            " ".join(words(rng, 300)).upper(), "日本語のテキスト " * 40, "a\x00b <|endoftext|> it's 12 o'clock  \r\n ok"]


def odd_rows():
    rows = [(i * 3, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s3"][i % 4], None if t is None else len(t),
             i, i, "u", "r", "f", "k", "s", "w") for i, t in enumerate(odd_texts())]
    rows += [rows[6], rows[6], rows[9]]                        # repeated rows
    rows += [(None,) + rows[8][1:], (None, None, None, None) + (None,) * 9]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents as a written table, with extra columns of clashing names."""
    from pulsehouse.llm.common import ship, written
    ship(spark)
    return written(spark.createDataFrame(odd_rows(), SCHEMA).repartition(3), "t-odd")


@pytest.fixture(scope="session")
def none(spark):
    from pulsehouse.llm.common import written
    return written(spark.createDataFrame([], SCHEMA), "t-none")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(3 * i, [1, 0, None][i % 3], [0, 1, None][i % 3]) for i in range(20)] + [(None, 1, 1)],
                                 "doc_id bigint, quality int, toxic int")
