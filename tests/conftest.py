import datetime as dt
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.session import local_session, shared_folder  # noqa: E402

UTC = dt.timezone.utc


# Made at import: test modules name columns at their top level.
SESSION = local_session(8, memory="4g")
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def folder(spark):
    """A maker of fresh folders."""
    return lambda purpose="test": shared_folder(spark, purpose)


@pytest.fixture
def column(spark):
    """Values of a column expression over the rows of one input column ``x``."""

    def evaluate(expression, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [row.y for row in df.select("i", expression.alias("y")).orderBy("i").collect()]

    return evaluate


@pytest.fixture
def landed(tmp_path):
    """A folder of JSON documents, one per file."""

    def write(*documents, name="in"):
        target = tmp_path / name
        target.mkdir(exist_ok=True)
        start = len(list(target.iterdir()))
        for i, document in enumerate(documents):
            body = document if isinstance(document, str) else json.dumps(document)
            (target / f"{start + i:04d}.json").write_text(body, encoding="utf-8")
        return str(target)

    return write


def rows(df, *order):
    """Rows as tuples, sorted."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def formatted(df):
    """The plan with the pushed filters in full."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
