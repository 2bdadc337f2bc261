"""Relational building blocks: DataFrame in, DataFrame out, nothing executed
(except the size check of a join side)."""

from tramline.operators.columns import (
    audit_stamp,
    drop_if_exists,
    drop_strict,
    literal_columns,
    project_columns,
    rename_map,
    rename_positional,
)
from tramline.operators.filters import (
    filter_hwm,
    filter_in_list,
    filter_not_like,
    filter_not_null,
    high_water_mark,
    require_fields,
)
from tramline.operators.joins import attach, fits, join_distinct, skew_join
from tramline.operators.sets import (
    distinct_pairs,
    distinct_sets,
    group_ordinals,
    one_set,
    sample_head,
    union_all_conformed,
    union_distinct,
)

__all__ = [
    "distinct_sets", "one_set",
    "attach", "audit_stamp", "distinct_pairs", "drop_if_exists", "drop_strict", "filter_hwm",
    "filter_in_list", "filter_not_like", "filter_not_null", "fits", "group_ordinals",
    "high_water_mark", "join_distinct", "literal_columns", "project_columns", "rename_map",
    "rename_positional", "require_fields", "sample_head", "skew_join", "union_all_conformed",
    "union_distinct",
]
