from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.schemas import BRONZE_CHUNKS  # noqa: E402
from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", app_name="tessera-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never reused)."""
    return tempfile.mkdtemp(prefix="tessera-test-")


@pytest.fixture()
def chunks_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, BRONZE_CHUNKS)
    return make


DOC_COLUMNS = ("extraction_id string, id_controller string, technology string, id_type string, "
               "ble_version string, document_sequence int, type string, payload_hex string")


@pytest.fixture()
def documents_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, DOC_COLUMNS)
    return make
