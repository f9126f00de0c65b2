"""Column -> Column codecs of the survey grid (all native Spark expressions)."""

from sectionmap.functions.geo import (  # noqa: F401
    township_number, range_number, township_str, range_str,
    trs_path_base, trs_paths, path_level, path_parent, path_in_subtree,
    validate_path,
)
from sectionmap.functions.subsec import (  # noqa: F401
    subsec_bits_lookup, subsec_name, subsec_bits, subsec_bits_list, subsec_cover,
    legacy_qq_bit, legacy_qq_list, popcount16,
)
from sectionmap.functions.names import (  # noqa: F401
    map_name, cc_doc_number, cc_doc_basename, surveyor_display,
    surveyor_display_ws, full_township, number_suffix, number_from_client,
    tract_from_client,
)
