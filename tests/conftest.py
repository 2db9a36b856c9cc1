import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from offerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one column expression over one row of named inputs."""

    def run(expr, **inputs):
        names = list(inputs) or ["_"]
        row = tuple(inputs.values()) or (1,)
        types = ", ".join(
            f"{n} {'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) and not isinstance(v, bool) else 'array<string>' if isinstance(v, list) else 'string'}"
            for n, v in zip(names, row)
        )
        return spark.createDataFrame([row], types).select(expr.alias("v")).first()[0]

    return run
