"""Documents that hold the odd cases, beside the session of the other tests."""

import pytest
from pyspark.sql import Row

WORDS = "the of thon ering tion with hand other re at".split()
LONG = " ".join(WORDS[i * i % 10] + WORDS[i % 7] for i in range(20_000))
TEXTS = {
    1: "Anan the of thon ering, with\nhand other re at the of thon. " * 4,
    2: None,
    3: "",
    4: " \t\n\x0b\x0c\r ",
    5: LONG,
    6: "one",
    7: "two words",
    8: "Ünï çödé ß ÀÉ İı 日本語 🙂🙂 e\u0301\u00a0x\u2003y \u3000 z",
    9: "don't I'll 123 45,6 --- !!! <|endoftext|> <|im_end|>  two  spaces \n\n lines \t",
    10: "a b c a b c a b c a b c " * 12,
    11: "same line\nsame line\n\nother\nsame line",
    12: "tied text of words",
    13: "tied text of words",
    14: "#$%& *** |x| <y> " * 30,
    15: "x" * 3000,
}


@pytest.fixture(scope="session")
def odd(spark):
    """doc_id, text, lang, source and columns whose names the operators use themselves."""
    rows = [
        Row(doc_id=i, text=t, lang="en" if i % 3 else None, source=None if i % 4 == 0 else "s", n_chars=len(t or ""), score="s", fp=i, _row=1, word=None, ids="i", n_words=-1, rejected=None, toxic=5)
        for i, t in TEXTS.items()
    ]
    rows += [rows[0], rows[1], Row(**{**rows[5].asDict(), "doc_id": None})]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, fp long, _row int, word string, ids string, n_words int, rejected boolean, toxic int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents, odd):
    """(doc_id, text) of the documents and the odd cases, ids kept apart."""
    return documents.select("doc_id", "text").unionByName(odd.selectExpr("doc_id + 1000000 as doc_id", "text"))
