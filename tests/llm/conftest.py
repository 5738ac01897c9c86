import random

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SYLLABLES = {"xx": ["ka", "lo", "mi", "ten", "ra", "su"], "yy": ["zor", "bek", "dun", "gla", "wis", "pim"]}


def prose(lang: str, words: int, seed: int) -> str:
    draw = random.Random(f"{lang}{seed}")
    out = []
    for i in range(words):
        word = "".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 3)))
        out.append(word + ("." if i % 9 == 8 else ""))
    return " ".join(out)


#: Columns whose names the operators use inside; none of them may clash.
CLASHES = ["_row", "fp", "row", "root", "part", "guest", "held_out", "spans", "owner", "class", "p", "_p", "word"]


@pytest.fixture(scope="session")
def corpus(spark):
    """120 documents in two languages; every seventh is toxic, every fifth of low quality."""
    rows, labels = [], []
    for i in range(120):
        lang = "xx" if i % 3 else "yy"
        text = prose(lang, 30 + i % 40, i)
        if i % 7 == 0:
            text = text.replace(" ", " vilest ", 2) + " rotten vilest"
        if i % 5 == 0:
            text = text.upper().replace(" ", "!! ")
        rows.append((i, text, lang, f"src{i % 4}", len(text)))
        labels.append((i, int(i % 5 != 0), int(i % 7 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, ids that repeat, clashing columns."""
    rows = [(1, None, None, None, None), (None, "some text here", "xx", "src1", 14), (2, "", "xx", None, 0),
            (3, " \n\t ", "yy", "src2", 4), (4, prose("xx", 30, 4), "xx", "src1", None),
            (4, prose("xx", 30, 4), "xx", "src1", None), (4, "another text of the same id", None, "src2", 1),
            (5, prose("yy", 20_000, 5), "yy", "src1", 1), (None, None, None, None, None),
            (6, "İstanbul ﬁne ▁x 日本 🙂 \x1c end\x00", "xx", "src3", 9), (7, prose("xx", 30, 4), "xx", "src2", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [r + (None,) * len(CLASHES) for r in rows]
    return spark.createDataFrame(rows, schema + "".join(f", `{c}` string" for c in CLASHES))
