"""Plans of registered queries: size of generated expressions, exchanges, limits."""

import pytest

from skein.plans import all_queries
from tests.conftest import SF001


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["ip_to_long", "ip_to_long_odd", "ip_region_lookup", "ip_region_lookup_broadcast", "income_by_region",
                                  "income_by_item", "log_size_stats", "multi_key_sort"])
def test_records_are_split_once(spark, name):
    plan = executed(all_queries()[name](spark, SF001))
    final = plan.split("== Initial Plan ==")[0]
    # One split of the record; the address fold names its own split six times (four parts,
    # their number, the general case), which code generation evaluates once.
    assert final.count("split(") <= (7 if name.startswith(("ip_", "income_by_region")) else 1)
    assert len(final) < 20_000


def test_range_lookups_have_no_nested_loop(spark):
    for name in ("ip_region_lookup", "ip_region_lookup_broadcast", "ip_region_lookup_multilevel"):
        assert "NestedLoop" not in executed(all_queries()[name](spark, SF001))
    assert "BroadcastHashJoin" in executed(all_queries()["ip_region_lookup_broadcast"](spark, SF001))


def test_key_partitions_read_the_input_once(spark):
    plan = executed(all_queries()["topn_group_partitions"](spark, SF001))
    assert "pages.parquet" not in plan and "Python" not in plan and "Pandas" not in plan


def test_positions_read_the_sorted_table_not_the_source(spark):
    assert "customer.parquet" not in executed(all_queries()["multi_key_sort"](spark, SF001))
