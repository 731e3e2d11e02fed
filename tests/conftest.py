import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quaystar.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Many small jobs: compiling them lightly takes less time than running them well.
    session = local_session(4, 3, **{"spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(frame, *columns):
        chosen = frame.select(*columns) if columns else frame
        return sorted((tuple(row) for row in chosen.collect()), key=str)

    return collect
