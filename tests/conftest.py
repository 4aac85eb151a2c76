from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from postloom.session import build_session

    session = build_session("tests", cpus=8, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before: dict[str, str | None] = {}

    def set_conf(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="session")
def posts(spark, sf_dir, tmp_path_factory):
    """Stored silver of the smallest data set."""
    from postloom.catalog.queries import silver_posts

    path = str(tmp_path_factory.mktemp("silver") / "posts")
    silver_posts(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)
