"""Column-expression helpers (all JVM-side, no Python per row)."""

from eddyline.functions.text import (  # noqa: F401
    java_split,
    java_ts_text,
    parse_sensor,
    sensor_to_doc,
    sensor_to_json,
    sensor_to_kv,
    sensor_to_string,
    text_lines,
    utf16_length,
)
