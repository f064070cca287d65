import random

import pytest
from pyspark.sql import functions as F

from anemoscope.llm import common

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for their own columns, or return.
CLASHING = [
    "score", "lang_pred", "shard", "slot", "chunk", "part", "rest", "whole", "blocks", "kept",
    "n", "cluster", "text_key", "component_id", "ids", "length", "source_tokens", "held_out",
    "key", "number", "row", "order", "__tokens", "__source", "__pass", "__block", "__place",
    "__order", "__hash", "__room", "__begin", "__whole", "__rest", "__blocks", "__language",
    "__likeness", "__key",
]


def odd_rows():
    """Nulls, empty, blank and very long texts, ties, copies and near copies."""
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(400)]
    body = lambda n: " ".join(draw.choices(words, k=n))
    base, passage, long = body(200), body(40), body(30_000)
    near = base.split()
    near[20:22] = ["other", "words"]
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "),
        (7, long), (8, body(60) + "\n" + passage), (9, passage + "\n" + body(70)),
        (10, body(60)), (10, body(60)), (11, "Çé日本語 \U0001f600 " * 30), (12, "one"),
        (13, "ab ab ab ab"), (14, "12 34 !!"), (None, body(50)), (None, base), (None, None),
        (15, "line one of text\nline one of text\n\nline two"), (16, "a  b   c \n\n d"),
    ]
    rows = [
        (i, t, ("en", "fr", None)[k % 3], ("s1", "s1", "s2", None)[k % 4], len(t or ""))
        for k, (i, t) in enumerate(texts)
    ]
    return [*rows, rows[0], rows[11]]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with extra columns of clashing names."""
    rows = spark.createDataFrame(odd_rows(), SCHEMA)
    return rows.withColumns({name: F.lit(7) for name in CLASHING}).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA).withColumns({n: F.lit(7) for n in CLASHING})


@pytest.fixture
def staging(spark):
    staging = common.Staging(spark)
    yield staging
    staging.release()


def root_of(parent, n):
    while parent.setdefault(n, n) != n:
        n = parent[n]
    return n
