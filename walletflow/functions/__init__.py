"""Column expressions (all JVM-side built-ins)."""

from walletflow.functions.address import (
    address_from_key,
    address_problem,
    address_to_binary,
    endpoint_path,
)
from walletflow.functions.jsonmap import (
    is_object,
    json_class,
    key_present,
    ordered_entries,
    text_or_default,
)
from walletflow.functions.text import (
    bool_text,
    default_file_name,
    ensure_csv_suffix,
    megabytes,
)

__all__ = [
    "address_from_key", "address_problem", "address_to_binary", "endpoint_path",
    "is_object", "json_class", "key_present", "ordered_entries", "text_or_default",
    "bool_text", "default_file_name", "ensure_csv_suffix", "megabytes",
]
