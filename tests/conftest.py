import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app_name="cohortlens-tests")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Build a text source (``value`` column) from Python strings."""
    def make(rows, partitions=1):
        return spark.createDataFrame([(r,) for r in rows], "value string").repartition(partitions)
    return make


# Micro-fixture: wide matrix with the header inside the data, and annotation.
MATRIX = [
    "PATIENT_ID,DIAGNOSIS,10,20,30",
    "P1,1,1,2,3",
    "P2,1,3,2,1",
    "P3,4,5,2,4",
    "P4,5,7,6,2",
    "P5,2,9,9,9",
    "P6,NA,9,9,9",
]
ANNOTATION = [
    "id,name,species,x,members",
    "c1,a,Human,,10;20",
    "c2,b,Human,,30",
    "c3,c,Mouse,,10",
    "c4,d,Human,,99",
]
