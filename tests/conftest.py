import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from copse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "copse-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("COPSE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sample(spark, folder):
    """A few hundred line items, as a frame and as arrays."""
    import numpy as np

    from copse.plans import views

    rows = views.li_xy(spark, folder).orderBy(*views.LI_FEATURES).limit(240).toPandas()
    return spark.createDataFrame(rows), rows[views.LI_FEATURES].to_numpy(float), np.array(rows["label"])
