import pytest

from martlane.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
    }
    return local_session("tests", "4", shuffle_partitions=4, config=folders)


@pytest.fixture(scope="session")
def rows():
    """Collects a frame as sorted tuples, NULL first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(map(tuple, picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
