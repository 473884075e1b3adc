import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from samples import DOC, corpus  # noqa: E402


@pytest.fixture(scope="session")
def docs_rows():
    return corpus()


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with extra columns whose names operators might use themselves."""

    def make(rows, sources=("b", "a", None, "c")):
        return spark.createDataFrame([(i, t, "en", sources[k % len(sources)], None if t is None else len(t), "c", "s", "w", "k", 1) for k, (i, t) in enumerate(rows)], DOC).repartition(3)

    return make


@pytest.fixture(scope="session")
def docs(frame, docs_rows):
    return frame(docs_rows)
