"""Small documents with every awkward case: nulls, empty, blank and very long texts, repeats, clashing columns."""

from __future__ import annotations

import random

import pytest

CLASHING = "id t digest tag size ids n norm fp members root component_id row_no shard slot seq block kind lang_pred rejected tokens".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHING) + ", extra map<string,string>"


def sentence(rng: random.Random, words: int, syllables: list[str]) -> str:
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(words)).capitalize() + "."


NORTH, SOUTH = ["th", "er", "an", "wo", "ld"], ["que", "lla", "ció", "ñas", "por"]


def edge_rows() -> list[tuple]:
    rng = random.Random(5)
    texts: list[tuple] = []
    for i in range(40):
        north = i % 2 == 0
        texts.append((i, sentence(rng, rng.randint(20, 60), NORTH if north else SOUTH), "no" if north else "so", f"src{i % 3}"))
    base = texts[0][1]
    texts += [
        (100, None, "no", "src0"), (101, "", None, "src0"), (102, "  \n\t ", "no", None), (103, "12 34 ++", "no", "src1"),
        (104, base, "no", "src0"), (105, base.upper(), "no", "src0"), (105, base.upper(), "no", "src0"), (None, base, "no", None),
        (106, "ab" * 100_000, None, "src1"), (107, (base + "\n") * 800, "no", "src2"), (108, "Ünïcödé 😀 ﬁ <|endoftext|> </s> [INST]", None, "srcX"),
        (109, "a b", "so", "src0"), (109, "c d", "so", "src0"), (110, "İstanbul ẞ x y\x1cz\x85", None, None),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *[str(i)] * len(CLASHING), {"k": "v"}) for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
