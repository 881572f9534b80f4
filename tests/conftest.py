import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    from tollhouse.sources.fixtures import star_tables

    return star_tables(spark, SF_DIR)


@pytest.fixture
def tables(spark):
    """Tables made of the given rows; tables not given are empty."""
    from tollhouse.sources.tables import Tables, schema

    def make(**rows):
        def source(name):
            fields = schema(name).fieldNames()
            data = [tuple(r.get(f) for f in fields) for r in rows.get(name, [])]
            return spark.createDataFrame(data, schema(name))

        return Tables(spark, source)

    return make
