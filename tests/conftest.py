import pytest

from tablekeeper.session import build_session
from tablekeeper.sources.files import literal_rows


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark__sql__shuffle__partitions": "8",
        "spark__ui__enabled": "false",
        "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("local[8]", "tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """`rows(schema, [tuples])` as a DataFrame."""
    return lambda schema, data: literal_rows(spark, schema, data)


@pytest.fixture
def staff(rows):
    """Invented employees: a null in every optional column and a repeated department."""
    return rows(
        "id int, name string, department string, level string, salary int, hired string, active boolean",
        [
            (1, "Ada", "Design", "Senior", 91000, "2021-03-01", True),
            (2, "Bo", "Design", "Junior", 61000, "2023-02-11", True),
            (3, "Cy", "Sales", "Senior", 72000, "2020-07-19", False),
            (4, "Di", "Sales", "Junior", None, "2023-06-30", True),
            (5, "Ed", None, "Senior", 88000, "2019-01-05", True),
            (6, None, "Legal", "Junior", 67000, "2022-10-10", False),
            (7, "Gus", "Design", None, 91000, "2023-02-11", None),
            (8, "Hal", "Legal", "Senior", 99000, None, True),
        ],
    )


def ids(frame, column="id"):
    return sorted(r[0] for r in frame.select(column).collect())


def table(frame):
    """Rows as a sorted list, nulls included."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
