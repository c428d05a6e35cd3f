from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


def made_documents():
    """Texts with copies, near copies, shared lines and passages, odd blanks, and edge cases."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäé", k=rng.randint(1, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, line, base = prose(60), "A line that many documents share, Really", prose(120)
    texts = [None, "", " \t\n", "one", "One two\vthree", "x" * 3000, "\n" * 40, "the same " * 200, "日本語 " * 30]
    for k in range(60):
        kind = k % 6
        if kind == 0:
            texts.append(prose(rng.randint(1, 300)))
        elif kind == 1:
            texts.append(base)
        elif kind == 2:
            own = base.split(" ")
            own[rng.randrange(len(own))] = "changed"
            texts.append("  ".join(own).upper() if k % 4 else " ".join(own))
        elif kind == 3:
            texts.append(f"{prose(30)} {passage} {prose(rng.randint(0, 40))}")
        elif kind == 4:
            texts.append("\n".join([prose(8), f"\t {line.upper() if k % 4 else line} ", prose(5), line]))
        else:
            texts.append(prose(20) + " " + prose(20) + " " + base[:300])
    ids = list(range(3, 3 + len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.fixture(scope="session")
def made():
    return made_documents()


@pytest.fixture(scope="session")
def made_frame(spark, made):
    """The made texts, read from a table, over several partitions."""
    from millrace.session import stage

    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}" if i % 5 else None, len(t or "")) for i, t in made]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return stage(frame.repartition(3), "made-documents")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def several_contents(spark, kind):
    """Rows that share a doc_id and differ in text."""
    from millrace.session import stage

    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    a, b, c, d = (prose(90) for _ in range(4))
    rows = [(1, a), (9, a), (9, b), (9, b), (9, None), (9, ""), (4, f"{c} {b[:150]}"), (12, f"{prose(30)} {c}"), (12, f"{d} {d}"), (12, d), (20, b)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], kind)
    return stage(frame.repartition(3), "several-contents")


@pytest.fixture(scope="session")
def edge_frames(spark):
    """Rows that operators must take: no rows; rows without a doc_id; equal rows."""
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"word{i}" for i in range(60))
    return {
        "empty": spark.createDataFrame([], kind),
        "no_ids": spark.createDataFrame([(None, text, None, None, None), (None, None, None, None, None), (1, text, None, None, None)], kind),
        "several": several_contents(spark, kind),
        "equal": spark.createDataFrame([(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, "en", "a", 1)], kind),
    }
