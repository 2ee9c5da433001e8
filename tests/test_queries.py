"""Every registered query against its SQL in DuckDB, over whole tables."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract
import pytest

import oracle

SF_DIR = "/root/testdata/sf0.01"
OWN = {name[2:] for name in vars(contract) if name.startswith("q_")}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert OWN == set(contract.OWN_SQL)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_oracle(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert oracle.compare(result, duck, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["xxhash", "zstandard", "public_tokenizers", "corpus_pipeline"])
def test_entry_without_what_only_the_corpus_needs(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.OWN_SQL))"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], capture_output=True, text=True)
    assert done.stdout.strip() == "True", done.stderr


def test_a_feed_of_a_table_in_one_part_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    names = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    rows = [(i, f"Customer#{i:09d}", i % 25, i / 4, "FURNITURE") for i in range(100)]
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(contract, "LISTINGS_PER_PART", 30)
    listings = contract._listings(spark, str(tmp_path))
    sizes = listings.rdd.glom().map(len).collect()
    assert sum(sizes) == 100 and sum(size > 0 for size in sizes) == 4 and max(sizes) <= 30
    assert listings.select("`Listing ID`").distinct().count() == 100
