from .aggregates import (  # noqa: F401
    dense_ids,
    distinct_counts,
    distinct_sum,
    lifecycle_total,
    max_then_sum,
    ordered_concat,
    ordered_texts,
    signed_union,
)
from .edits import replace_slice, unpivot_nonzero, update_from  # noqa: F401
from .joins import (  # noqa: F401
    block_product,
    code_table,
    dyadic_blocks,
    exists_flag,
    host_window_filter,
    interval_join,
    net_debit_credit,
    spine_join,
    spine_measures,
    spine_of,
    spine_table,
    validity_join,
)
from .membership import key_filter, reduced, sifted  # noqa: F401
from .numbering import document_numbers, first_per_group, number_within, quantile_bucket  # noqa: F401
