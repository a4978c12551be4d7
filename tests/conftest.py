import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import session  # noqa: E402
from clipsieve import prepare_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    active = prepare_session(session(cores=8))
    yield active
    active.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column function over literal inputs and return the results as a list."""

    def run(function, inputs, kind="string"):
        rows = [(i, value) for i, value in enumerate(inputs)]
        frame = spark.createDataFrame(rows, f"i int, x {kind}")
        return [row[0] for row in frame.orderBy("i").select(function(frame["x"]).alias("r")).collect()]

    return run
