"""Small document tables for the operator tests."""

import random

from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts, ids=None):
    """A documents table of the given texts (ids count from 0)."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


def letters(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 8))) for _ in range(words))


# Every operator must take these: NULLs, empty and blank texts, odd characters, a very long text and repeated rows.
ODD_TEXTS = [None, "", " \n\t ", "a", "é ñ 中文 😀", "!!! ...", "one two three four", "x " * 30_000, "tab\tand\r\nreturn\x1cseparator",
             "repeated row " * 8, "repeated row " * 8]
ODD_IDS = [0, 1, 2, 3, 4, None, 6, 7, 8, 9, 9]


def odd_documents(spark: SparkSession):
    """Odd texts and ids, and columns named like what operators add."""
    df = documents(spark, ODD_TEXTS, ODD_IDS)
    return df.selectExpr("*", "doc_id as score", "text as _id", "lang as sequence_id", "1 as n_words", "2 as block", "'t' as leaf", *(
        f"{7 + k} as {c}" for k, c in enumerate(("_toxicity", "_n_lines", "_n_dropped", "_tm_did", "_tm_th", "_tm_dropped", "_tm_id", "_tm_row", "toxic", "rows"))))
