from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Start int, `words` string"


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    """Sentences of made-up words."""
    out = []
    for k in range(n):
        word = "w" + str(rng.randrange(words)) + "é" * (rng.random() < 0.02)
        out.append(word.capitalize() + "." if k % 9 == 8 else word)
    return " ".join(out)


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join("x" + str(rng.randrange(10**6)) if rng.random() < share else w for w in text.split(" "))


def corpus(seed: int = 1) -> list[tuple]:
    """Documents with copies, near copies, shared passages, empty, null and very long texts, ties and repeated rows.

    Two columns more than the table has bear names that operators might use themselves.
    """
    rng = random.Random(seed)
    texts: list[str | None] = [prose(rng, rng.randrange(20, 300)) for _ in range(60)]
    base = prose(rng, 160, 5000)
    texts += [base] * 5
    texts += [edited(rng, base, s) for s in (0.004, 0.01, 0.02, 0.03, 0.05, 0.1) for _ in range(3)]
    passage = prose(rng, 90, 5000)
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 20)}" for _ in range(8)]
    texts += ["", None, " ", "\n\n", "a", "A b c D", "a B C d", "x\ty  z\n\n\nq", "\x00 a\x00b", "日本語 テキスト。 ünï"]
    texts += ["abc " * 600, "z" * 1500, prose(rng, 30_000, 3000), "one line\n" * 80, "### && " * 90]
    rows = [(k, t, "en" if k % 3 else None, f"src{k % 4}" if k % 7 else None, len(t or ""), k, "w") for k, t in enumerate(texts)]
    return rows + rows[3:5] + rows[60:61] + [(None, "no id " + prose(rng, 70), "de", "src1", 5, None, None)]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
