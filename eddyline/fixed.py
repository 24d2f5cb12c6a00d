"""Formats, names and constants that must equal the reference's
for the outputs to match. Stated here once, as plain text; the code uses them."""

# --- fixed values (output formats) ---
SENSOR_TEXT_FORMAT = "WaterSensor{id='%s', ts=%s, vc=%s}"
WINDOW_TEXT_FORMAT = "TimeWindow{start=%s, end=%s}"
WINDOW_COUNT_TEXT_FORMAT = "Window: %scount: %s"
WINDOW_LABEL_FORMAT = "%s:%s"
TUPLE_KEY_FORMAT = "(%s)"
PRINT_LABEL_FORMAT = "%s> %s"

# --- fixed values (names used by the reference programs) ---
INDEX_NAME = "sensor1"
