import os

import pytest
from pyspark.sql import Row

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS[(i * 7 + i * i) % 400] for i in range(30_000))  # longer than a chunk and than a slice of words
PARA = "the quick brown fox jumps over the lazy dog while seven wizards boldly quiz a jumbo vixen near the old stone bridge at dawn"

#: doc_id, text: nulls, blanks, ties, repeats, long and short texts.
ODD = [
    (1, "alpha beta gamma delta epsilon zeta"), (2, "alpha beta gamma delta epsilon zeta"), (3, None), (4, ""), (5, " \t\n "), (6, "word"),
    (7, "Word"), (8, "a b c d e"), (9, "A b C d e"), (10, LONG), (11, LONG + " tail"), (12, LONG), (12, LONG), (13, PARA), (14, PARA + " again"),
    (None, "no id here at all today"), (None, None), (15, "12345 !!! ???"), (16, "漢字かな交じり文 с кириллицей"), (17, "x" * 5000), (18, "two  blanks \n and\r\nlines "),
    (19, PARA.upper()), (20, "<|endoftext|> is plain text"), (1, "alpha beta gamma delta epsilon zeta"),
]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """The odd documents as a file table, with columns whose names clash with the operators' own."""
    path = os.path.join(str(tmp_path_factory.mktemp("odd")), "documents.parquet")
    rows = [Row(doc_id=i, text=t, lang=None if k % 3 else "en", source="s", n_chars=len(t or ""), uid=5, n=1, c="c", s=2, x=3, root=4, kept=False,
                row_uid=7, start=1, end=2, kind="k", label_id=9, toxic=1, bytes=b"b", part=1, host="h", fold=1, hilbert=0) for k, (i, t) in enumerate(ODD)]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, uid int, n int, c string, s int, x int, root int, kept boolean, "
              "row_uid int, start int, end int, kind string, label_id int, toxic int, bytes binary, part int, host string, fold int, hilbert int")
    spark.createDataFrame([tuple(r) for r in rows], schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, odd, tmp_path_factory):
    path = os.path.join(str(tmp_path_factory.mktemp("empty")), "documents.parquet")
    odd.limit(0).write.parquet(path)
    return spark.read.schema(odd.schema).parquet(path)
