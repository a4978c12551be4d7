import pytest
from pyspark.sql import functions as F

from clipsieve.functions.numbers import fixed


@pytest.mark.parametrize("digits", [2, 3])
def test_as_python_writes_them(values, digits):
    given = [0.125, 0.375, 0.0625, 0.1875, 0.5, 2.675, 1 / 3, 0.0, 1.0, 0.005, 1234567.0625, -0.375, 0.9995]
    assert values(lambda x: fixed(x, digits), given, "double") == [f"{x:.{digits}f}" for x in given]


def test_null(values):
    assert values(lambda x: F.format_string("a %s", fixed(x, 2)), [None], "double") == ["a null"]
