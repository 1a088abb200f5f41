import pytest
from pyspark.sql import Row

from tidemark.llm.common import on_workers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    on_workers(spark)


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and columns named like results."""
    long = " ".join(f"word{i % 977} the of" for i in range(6000))
    rows = [
        (1, "", "x"), (2, None, None), (None, "alone and without an id", "y"), (3, "  \n\t ", "z"),
        (4, long, "x"), (5, long, "x"), (5, long, "x"), (6, "12345 !!! ---", "x"),
        (7, "naïve café — déjà vu   日本語 𠀀 '' 's't \u0000   end  ", "x"), (8, "a", "x"),
    ]
    return spark.createDataFrame(
        [Row(doc_id=a, text=b, lang=c, n_tokens=0, id="clash", spans="clash", score=1.0, key=9) for a, b, c in rows],
        "doc_id long, text string, lang string, n_tokens int, id string, spans string, score double, key int",
    )


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
