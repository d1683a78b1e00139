from ledgermill.operators.distinct import count_few_values
from ledgermill.operators.history import history_changes, scd2_check
from ledgermill.operators.latest import latest_of_repeated, latest_per_key
from ledgermill.operators.lookup import fits_broadcast, join_reference
from ledgermill.operators.merge import merge_metrics
from ledgermill.operators.skew import spread_join

__all__ = [
    "count_few_values",
    "fits_broadcast",
    "history_changes",
    "join_reference",
    "latest_of_repeated",
    "latest_per_key",
    "merge_metrics",
    "scd2_check",
    "spread_join",
]
