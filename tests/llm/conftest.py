import pytest

CLASH = "lang string, source string, score double, spans string, fp long, node long, component_id long, rule int, host string, word string"


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def texts(spark, sf_dir):
    return dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())


@pytest.fixture
def make(spark):
    """Documents of (doc_id, text) rows with other columns whose names an operator might use itself."""

    def build(rows):
        full = [(i, t, "en", "src1", 0.5, "s", 1, 2, 3, 4, "h", "w") for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {CLASH}")

    return build
