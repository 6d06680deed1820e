"""DataFrame operators: counting, ranking, range lookup, key placement."""

from skein.operators.counting import (
    combine_by_key,
    combine_placed,
    count_by,
    distinct_keys,
    field_stats,
    grand_total,
    sum_by,
)
from skein.operators.partitioning import key_ids, map_partitions, partition_per_key, top_n_batches
from skein.operators.rangejoin import RangeIndex, check_rules, range_lookup, rule_violations
from skein.operators.ranking import (
    order_columns,
    sort_by_rule,
    position_in_ranges,
    top_counts_all_keys,
    top_n,
    top_n_distinct_counts,
    top_n_per_group,
    with_position,
)

__all__ = [
    "RangeIndex",
    "check_rules",
    "combine_by_key",
    "combine_placed",
    "count_by",
    "distinct_keys",
    "field_stats",
    "grand_total",
    "key_ids",
    "map_partitions",
    "order_columns",
    "partition_per_key",
    "range_lookup",
    "rule_violations",
    "sort_by_rule",
    "sum_by",
    "position_in_ranges",
    "top_counts_all_keys",
    "top_n",
    "top_n_batches",
    "top_n_distinct_counts",
    "top_n_per_group",
    "with_position",
]
