import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusmill.session import build_session

FRAGMENTS = [
    "http://a.b/c", "HTTP://X", "https", "www", "www.x", "rt", "RT", "art", "RT:", "@bob", "@ñ_1²", "a@b", "@",
    "\n", "\t", " ", " ", "\x1c", "\x1f", "é", "é", "你好", "no1", "it's", "don't", '"q"', "--",
    "😀", "x́", "_rt", "½", " ", "  ", "The", "the cat", "NOT", "...", "!?", "U2-fan!!", "_", "$+<=>^`|~",
    "«q»", "、", "Ñandú", "12 3", "ﬁ", " ", "‍", "�", "\x07", "ひら", "カター", "мир", "Straße", "ΑΣ", "\r",
]


# Made at import, so that test modules can hold column expressions in their parameters.
SESSION = build_session(
    master="local[8]",
    **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1", "spark.driver.bindAddress": "127.0.0.1",
    },
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def strings():
    rng = random.Random(7)
    made = ["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    return ["", " ", "\n", *made]


@pytest.fixture(scope="session")
def string_frame(spark, strings):
    return spark.createDataFrame(list(enumerate(strings)), "i int, t string").repartition(8).cache()


def column_values(frame, column):
    """The values of an expression over the frame of random strings, in order."""
    return [r[1] for r in sorted(frame.select("i", column.alias("v")).collect(), key=lambda r: r[0])]


def same(got, wanted, inputs):
    wrong = [(i, g, w) for i, g, w in zip(inputs, got, wanted, strict=True) if g != w]
    assert not wrong, f"{len(wrong)} of {len(got)} differ, first: {wrong[:3]}"
