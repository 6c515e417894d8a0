import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, key string, removed string, gone_id long, component long, toxicity string, first long, size int")
LONG = " ".join(f"word{i % 977} filler" for i in range(30_000))


def messy_rows():
    """Null ids and texts, empty and blank texts, a very long one, repeated rows, ties."""
    texts = [(1, "Alpha beta gamma.\nSecond line of words here."), (2, None), (3, ""), (4, " \t\n \n"), (5, LONG),
             (6, "Alpha beta gamma.\nSecond line of words here."), (7, "x"), (None, "No id but some words."),
             (7, "x"), (9, "ünïcode ① 你好 \x00 end"), (10, "é" * 3000),
             (11, "1." + "0" * 5000 + "300.2.3 and " + "7" * 9000 + " +" + "1" * 5000)]
    return [(i, t, None if i == 3 else "en", "src0", None if t is None else len(t), 0.5, "k", "r", 3, 4, "t", 5, 6) for i, t in texts]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(folder):
    import duckdb

    return duckdb.sql(f"select doc_id, text, lang from '{folder}/documents.parquet' order by doc_id").fetchall()
