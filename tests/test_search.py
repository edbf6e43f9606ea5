"""The word index against the scan."""
import pytest

from tessera.operators.catalog import search_union
from tessera.session import scratch_dir
from tessera.sources.search import build_index, search_index

ROWS = [("1", "JP | CPI - Food, total | Japan"), ("1", "JP | PPI | Tokyo"), ("2", "cpi-tokyo\tENERGY"), ("3", None),
        ("4", ""), ("5", "Japan CPI"), ("5", "Another Japan CPI"), ("6", "a%b_c (x) | Index"), ("7", "ÄRGER Straße"), (None, "Japan PPI")]


@pytest.fixture(scope="module")
def catalog(spark):
    raw = spark.createDataFrame(ROWS, "instrument_id string, name string")
    return raw, build_index(spark, raw, scratch_dir(spark, "t-index"))


@pytest.mark.parametrize("sets", [["Japan CPI"], ["cpi tokyo"], ["food,"], ["FOO"], ["%", "(x)"], ["nothing"], ["cpi japan", "energy tokyo"],
                                  ["ärger"], [""], ["", "cpi"], ["cpi cpi CPI"], ["ppi food"], ["| jp"]])
def test_index_equals_scan(spark, catalog, sets):
    raw, path = catalog
    want = search_union(raw.where("name is not null"), sets)
    assert sorted(map(str, search_index(spark, path, sets).collect())) == sorted(map(str, want.collect()))


def test_no_set_and_empty_table(spark, catalog):
    assert search_index(spark, catalog[1], []).count() == 0
    empty = build_index(spark, catalog[0].limit(0), scratch_dir(spark, "t-index-empty"))
    assert search_index(spark, empty, ["cpi"]).count() == 0


def test_only_the_words_buckets_are_read(spark, catalog):
    plan = search_index(spark, catalog[1], ["energy"])._jdf.queryExecution().executedPlan().toString()
    filters = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:] if "bucket" in p.split("]")[0]]
    assert filters and all(" IN " in f or "=" in f for f in filters)
