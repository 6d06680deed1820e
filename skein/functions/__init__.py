"""Column expressions (all JVM-side; no Python UDFs)."""

from skein.functions.net import ip_to_long
from skein.functions.records import (
    field,
    join_fields,
    number_field,
    parse_hash_logs,
    parse_ip_rules,
    parse_orders,
    parse_users,
    render_tuple,
    render_user,
)
from skein.functions.text import fixed2, jvm_split, not_blank, text_lines, tokens
from skein.functions.url import HOST_LABEL_PATTERN, host_label, last_segment, subject_teacher

__all__ = [
    "HOST_LABEL_PATTERN",
    "field",
    "fixed2",
    "host_label",
    "ip_to_long",
    "join_fields",
    "jvm_split",
    "last_segment",
    "not_blank",
    "number_field",
    "parse_hash_logs",
    "parse_ip_rules",
    "parse_orders",
    "parse_users",
    "render_tuple",
    "render_user",
    "subject_teacher",
    "text_lines",
    "tokens",
]
