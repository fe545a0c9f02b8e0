import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A data frame with a clashing extra column beside the named ones."""

    def make(rows, ddl):
        return spark.createDataFrame([(*r, "x") for r in rows], ddl + ", block string")

    return make
