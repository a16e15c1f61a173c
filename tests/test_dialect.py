import csv
import random

import pytest
from pyspark.sql import functions as F

from longform.functions.dialect import CsvDialect

PIECES = ["", "a", '"q"', '"', '""', ",", ";", " ", "b c", "'", "x,y", '"m,n"', '"d""d"', "\\", "|", "\t", "é"]


def records(seed, n=400):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 9))) for _ in range(n)]


@pytest.mark.parametrize(
    "dialect, options",
    [
        (CsvDialect(), {}),
        (CsvDialect(delimiter=";"), {"delimiter": ";"}),
        (CsvDialect(delimiter="\t"), {"delimiter": "\t"}),
        (CsvDialect(delimiter="|", quotechar="'"), {"delimiter": "|", "quotechar": "'"}),
        (CsvDialect(quotechar=None), {"quoting": csv.QUOTE_NONE}),
        (CsvDialect(skipinitialspace=True), {"skipinitialspace": True}),
        (CsvDialect(doublequote=False), {"doublequote": False}),
        (CsvDialect(escapechar="\\"), {"escapechar": "\\"}),
        (CsvDialect(escapechar="\\", doublequote=False), {"escapechar": "\\", "doublequote": False}),
    ],
)
def test_cells_are_those_of_csv_reader(spark, dialect, options):
    # a lone escape at a record's end is the reader's own special case
    texts = [t for t in records(7) if not (dialect.escapechar and t.endswith("\\"))]
    want = [next(csv.reader([t], **options), []) if t else [] for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.c for r in df.select("i", dialect.cells(F.col("t")).alias("c")).orderBy("i").collect()]
    wrong = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not wrong, wrong[:5]


def test_long_cells_do_not_overflow_the_matcher(spark):
    text = '"' + 'x""y' * 60_000 + '",tail'
    df = spark.createDataFrame([(text,)], "t string")
    cells = df.select(CsvDialect().cells(F.col("t")).alias("c")).first().c
    assert cells == ['x"y' * 60_000, "tail"]


@pytest.mark.parametrize("bad", [{"delimiter": "::"}, {"quotechar": ""}])
def test_options_are_single_characters(bad):
    with pytest.raises(ValueError):
        CsvDialect(**bad)
