import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Tests name the folder that a cluster names in its settings."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        folder = tmp_path_factory.mktemp("shared").as_uri()
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
