from estrato.functions.columns import (
    blank_to_null,
    decode_file_name,
    depth_step,
    finite,
    location_label,
    mid_depth,
    parse_number,
    sentinel_to_null,
    site_name,
    test_type,
)

__all__ = [
    "blank_to_null", "decode_file_name", "depth_step", "finite", "location_label",
    "mid_depth", "parse_number", "sentinel_to_null", "site_name", "test_type",
]
