"""Registered queries with SQL, over whole tables, and that nothing else needs this package."""

import subprocess
import sys
from pathlib import Path

import oracle
import pytest

from filefeatures.llm import queries as registered
from filefeatures.llm.exact_dedup import dedup
from filefeatures.llm.sharding import shard

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert oracle.compare(registered.queries()[name](spark, SF_DIR), duck, registered.oracle_sql()[name]) is None


@pytest.mark.parametrize("limit", [300_000, 40_000, 3_000])
def test_shards_of_other_sizes_equal_sql(documents, duck, limit):
    assert oracle.compare(shard(documents, limit=limit), duck, registered.shard_sql(limit)) is None


@pytest.mark.parametrize("block_bytes", [64, 700])
def test_dedup_with_many_levels_equals_sql(documents, duck, block_bytes):
    assert oracle.compare(dedup(documents, block_bytes=block_bytes).drop("row"), duck, registered.DEDUP_SQL) is None


def test_thirteen_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registered.queries())
    assert numbers == list(range(1, 14))


def test_the_library_does_not_import_this_package():
    code = "import sys, filefeatures.__main__; assert not any(m.startswith('filefeatures.llm') for m in sys.modules)"
    root = Path(__file__).parents[2]
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True).returncode == 0
