import os
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from appendlake import LakeConfig  # noqa: E402
from appendlake.operators import ledger  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    """An empty lake with small chunks and few buckets."""
    config = LakeConfig(
        f"{tmp_path}/source", f"{tmp_path}/ranges", f"{tmp_path}/tables",
        log_schema=f"lake_{uuid.uuid4().hex}", log_root=f"{tmp_path}/logs",
        chunk_bytes=200, bucket_count=8,
    )
    ledger.ensure_logs(spark, config)
    return config


@pytest.fixture
def put(lake):
    """Append text to a source file of the lake."""

    def write(entity, name, text, mode="ab"):
        folder = f"{lake.source_root}/{entity}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}", mode) as out:
            out.write(text.encode())

    return write
