import pytest

from caretiers import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def resources(spark):
    """Bronze frame of resources given as JSON text."""

    def make(*texts):
        rows = [("f.json", "b", None, text) for text in texts]
        df = spark.createDataFrame(rows, "_source_file string, _source_bundle string, _full_url string, text string")
        return df.selectExpr("_source_file", "_source_bundle", "_full_url", "parse_json(text) AS resource")

    return make
