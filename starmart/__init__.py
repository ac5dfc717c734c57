"""Star-schema enrichment of travel records as Spark DataFrame transforms."""

from starmart.functions.text import city_of, joined_key
from starmart.operators.buckets import merge_buckets, read_buckets
from starmart.operators.clean import LabelRule, drop_columns, drop_invalid_labels
from starmart.operators.enrich import Dimension, enrich, match_shares, one_row_per_key
from starmart.operators.joins import BROADCAST_BYTES, new_keys_only, skew_join
from starmart.operators.label_splits import split_label_dictionary
from starmart.operators.labels import document_lines, kept_lines, label_dictionary, last_wins
from starmart.operators.lookup import Lookup, decode
from starmart.operators.manifests import content_report, require_contents, sealed, write_manifest
from starmart.operators.pivot import (
    attach_pivot,
    cell_of,
    merge_sparse_pivots,
    pivot_counts,
    sparse_pivot,
    unpivot_columns,
)
from starmart.operators.quality import (
    null_audit,
    output_report,
    require_clean,
    require_outputs,
    require_rows,
    row_counts,
    value_profile,
    write_gated,
)
from starmart.operators.states import add_months, mean_of_states
from starmart.operators.trailing import (
    latest_per_key,
    latest_year,
    mean_by,
    within_latest_years,
)
from starmart.sources.readers import read_code_map, read_csv, read_documents, read_parquet
from starmart.sources.records import read_csv_checked, read_csv_records
from starmart.sources.scratch import materialize, scratch_path
from starmart.sources.writers import (
    write_csv,
    write_dictionary,
    write_if_absent,
    write_parquet,
    write_single_csv,
)

__all__ = [
    "BROADCAST_BYTES",
    "Dimension",
    "LabelRule",
    "Lookup",
    "add_months",
    "attach_pivot",
    "cell_of",
    "city_of",
    "content_report",
    "decode",
    "document_lines",
    "drop_columns",
    "drop_invalid_labels",
    "enrich",
    "joined_key",
    "kept_lines",
    "label_dictionary",
    "last_wins",
    "latest_per_key",
    "latest_year",
    "match_shares",
    "materialize",
    "mean_by",
    "mean_of_states",
    "merge_buckets",
    "merge_sparse_pivots",
    "new_keys_only",
    "null_audit",
    "one_row_per_key",
    "output_report",
    "pivot_counts",
    "read_buckets",
    "read_code_map",
    "read_csv",
    "read_csv_checked",
    "read_csv_records",
    "read_documents",
    "read_parquet",
    "require_clean",
    "require_contents",
    "require_outputs",
    "require_rows",
    "row_counts",
    "scratch_path",
    "sealed",
    "skew_join",
    "sparse_pivot",
    "split_label_dictionary",
    "unpivot_columns",
    "value_profile",
    "within_latest_years",
    "write_csv",
    "write_dictionary",
    "write_gated",
    "write_if_absent",
    "write_manifest",
    "write_parquet",
    "write_single_csv",
]
