import pytest

from cellspark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column expression over one column ``x`` of given values, in order."""

    def run(items, dtype, expression):
        rows = [(i, item) for i, item in enumerate(items)]
        df = spark.createDataFrame(rows, f"i int, x {dtype}")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]

    return run
