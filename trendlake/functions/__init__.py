"""Column functions: plain expressions, no state, no I/O."""

from .fields import field, field_or, flatten_struct, has_field
from .means import (
    count_mean, merged_rate_parts, rate_mean, rate_mean_of_parts, rate_mean_of_sums, rate_parts,
    rate_sums, whole_sum_of, whole_sums, whole_total,
)
from .paths import file_kind, file_region, is_data_file, name_prefix_region, path_region
from .values import (
    decode_document, encode_document, normal_region, parse_trending_date, region_filter, region_list, share_percent,
    short_date, total_order, try_timestamp,
)

__all__ = [
    "field", "field_or", "flatten_struct", "has_field",
    "file_kind", "file_region", "is_data_file", "name_prefix_region", "path_region",
    "count_mean", "merged_rate_parts", "rate_mean", "rate_mean_of_parts", "rate_mean_of_sums", "rate_parts", "rate_sums",
    "whole_sum_of", "whole_sums", "whole_total",
    "decode_document", "encode_document", "normal_region", "parse_trending_date", "region_filter", "region_list",
    "share_percent", "short_date", "total_order", "try_timestamp",
]
