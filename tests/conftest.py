import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from compare import local_session

    return local_session()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def small_store(spark):
    from arrears.operators.store import feature_store
    from arrears.sources import tpch
    from arrears.sources.staging import stage

    return stage(feature_store(tpch.tables(spark, SMALL)))


@pytest.fixture(scope="session")
def planted(spark):
    """6,000 rows whose label depends on the first of five features; some values missing."""
    import numpy as np
    from arrears.sources.staging import stage

    rng = np.random.default_rng(7)
    x = rng.normal(size=(6000, 5))
    y = (rng.random(6000) < 1 / (1 + np.exp(-(1.8 * x[:, 0] - 1.5)))).astype(int)
    missing = rng.random(x.shape) < 0.1
    rows = [
        (i, int(y[i]), *[None if missing[i, j] else float(x[i, j]) for j in range(5)])
        for i in range(len(x))
    ]
    schema = "SK_ID_CURR bigint, TARGET int, " + ", ".join(f"f{j} double" for j in range(5))
    return stage(spark.createDataFrame(rows, schema))
