import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from corvane.session import build

    s = build("local[4]", 4, **{"spark.default.parallelism": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    return s
