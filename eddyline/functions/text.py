"""Text helpers that follow the record-at-a-time semantics of the reference
programs (Java string rules) but run as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.fixed import SENSOR_TEXT_FORMAT

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


_REGEX_META = ".$|()[{^?*+\\"


def _quote(sep: str) -> str:
    """Literal separator as a Java regex. One plain character (or one escaped
    metacharacter) keeps Java's non-regex fast path for ``split``."""
    if len(sep) == 1:
        return "\\" + sep if sep in _REGEX_META else sep
    if "\\E" in sep:
        return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return "\\Q" + sep + "\\E"


def java_split(col: ColumnOrName, sep: str = " ") -> Column:
    """``String.split(sep)`` with a literal separator.

    Java keeps leading and inner empty strings, drops trailing ones, gives
    ``[""]`` for the empty string and ``[]`` when only separators remain.
    Spark's ``split`` keeps trailing empties, so they are stripped first.
    """
    c = _c(col)
    pat = _quote(sep)
    if len(sep) == 1:
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, f"(?:{pat})+\\z", "")
    empty = F.array().cast(T.ArrayType(T.StringType()))
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(stripped == "", empty)
        .otherwise(F.split(stripped, pat, -1))
    )


def text_lines(col: ColumnOrName) -> Column:
    """Lines of a text as a line reader yields them: split on ``\\n``, no extra
    line after a final newline, no line at all for an empty text. A ``\\r``
    before the newline stays on the line here; ``strip_cr`` removes it."""
    c = _c(col)
    body = F.when(c.endswith("\n"), F.expr("substring({0}, 1, length({0}) - 1)".format(_sql_name(col)))).otherwise(c)
    empty = F.array().cast(T.ArrayType(T.StringType()))
    return F.when(c == "", empty).otherwise(F.split(body, "\n", -1))


def strip_cr(col: ColumnOrName) -> Column:
    """Drop one ``\\r`` that ended a ``\\r\\n`` line terminator."""
    c = _c(col)
    return F.when(c.endswith("\r"), F.expr("substring({0}, 1, length({0}) - 1)".format(_sql_name(col)))).otherwise(c)


def _sql_name(col: ColumnOrName) -> str:
    if not isinstance(col, str):
        raise TypeError("pass a column name")
    return f"`{col}`"


def utf16_length(col: ColumnOrName) -> Column:
    """``String.length()``: UTF-16 code units (a character outside the BMP counts 2)."""
    return (F.octet_length(F.encode(_c(col), "UTF-16BE")) / 2).cast("bigint")


def java_ts_text(col: ColumnOrName) -> Column:
    """``java.sql.Timestamp.toString``: ``yyyy-MM-dd HH:mm:ss.f`` with the fraction
    trimmed of trailing zeros but at least one digit."""
    s = _c(col).cast("string")
    return F.when(F.instr(s, ".") > 0, s).otherwise(F.concat(s, F.lit(".0")))


# Java's Long.parseLong accepts an optional sign and digits only (no blanks).
_LONG_TEXT = r"^[+-]?[0-9]+$"
# Spark's double cast also takes these spellings, Java's Double.parseDouble does not
# (Java accepts only the exact forms NaN and Infinity).
_SPECIAL_DOUBLE_ANY_CASE = r"^\s*[+-]?(?i:inf|infinity|nan)\s*$"
_SPECIAL_DOUBLE_JAVA = r"^\s*[+-]?(?:Infinity|NaN)\s*$"


def parse_sensor(
    df: DataFrame,
    col: str = "value",
    sep: str = ",",
    on_error: str = "fail",
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame | None]:
    """Parse ``id,ts,vc`` lines into (id string, ts bigint, vc double).

    Extra fields are ignored. ``on_error='fail'`` (the reference's behaviour)
    raises on a short or non-numeric line, ``'drop'`` skips such lines and
    ``'quarantine'`` also returns them as a second DataFrame.
    """
    parts = java_split(F.col(col), sep)
    raw = df.select(*keep, F.col(col).alias("_line"), parts.alias("_p"))
    id_ = F.get(F.col("_p"), 0)
    ts_txt = F.get(F.col("_p"), 1)
    vc_txt = F.get(F.col("_p"), 2)
    ts_val = F.when(ts_txt.rlike(_LONG_TEXT), F.expr("try_cast(get(_p, 1) as bigint)"))
    spark_only = vc_txt.rlike(_SPECIAL_DOUBLE_ANY_CASE) & ~vc_txt.rlike(_SPECIAL_DOUBLE_JAVA)
    vc_val = F.when(~spark_only, F.expr("try_cast(get(_p, 2) as double)"))
    if on_error == "fail":
        # raise_error fails the task, and so the job, as the reference's parser does. The
        # check is a filter, so it also runs where no parsed column is asked for (count()). The
        # random number keeps the filter above the parsing; pushed below, it would parse again.
        bad = F.concat(F.lit("bad sensor line: "), F.coalesce(F.col("_line"), F.lit("null")))
        parsed = raw.select(
            *keep, "_line", id_.alias("id"), ts_val.alias("ts"), vc_val.alias("vc"), F.rand(0).alias("_above")
        )
        fine = (F.col("_above") >= 0) & F.col("id").isNotNull() & F.col("ts").isNotNull() & F.col("vc").isNotNull()
        checked = parsed.filter(F.when(fine, F.lit(True)).otherwise(F.raise_error(bad).cast("boolean")))
        return checked.select(*keep, "id", "ts", "vc"), None
    ok = id_.isNotNull() & ts_val.isNotNull() & vc_val.isNotNull()
    tagged = raw.select(*keep, "_line", id_.alias("id"), ts_val.alias("ts"), vc_val.alias("vc"), ok.alias("_ok"))
    good = tagged.filter("_ok").select(*keep, "id", "ts", "vc")
    if on_error == "drop":
        return good, None
    if on_error == "quarantine":
        bad = tagged.filter(~F.col("_ok")).select(*keep, F.col("_line").alias("value"))
        return good, bad
    raise ValueError(f"on_error must be fail, drop or quarantine, not {on_error!r}")


def sensor_to_json(id_: ColumnOrName = "id", ts: ColumnOrName = "ts", vc: ColumnOrName = "vc") -> Column:
    """Record as JSON text ``{"id":..,"ts":..,"vc":..}``; null fields are left out."""
    return F.to_json(F.struct(_c(id_).alias("id"), _c(ts).alias("ts"), _c(vc).alias("vc")))


def sensor_to_doc(ts: ColumnOrName = "ts", vc: ColumnOrName = "vc") -> Column:
    """Document of strings ``{ts: "..", vc: ".."}`` (the id is not part of it)."""
    return F.create_map(F.lit("ts"), _c(ts).cast("string"), F.lit("vc"), _c(vc).cast("string"))


def sensor_to_kv(id_: ColumnOrName = "id", vc: ColumnOrName = "vc") -> Column:
    """(key, value) pair for a hash entry: id and vc as text."""
    return F.struct(_c(id_).alias("key"), _c(vc).cast("string").alias("value"))


def sensor_to_string(id_: ColumnOrName = "id", ts: ColumnOrName = "ts", vc: ColumnOrName = "vc") -> Column:
    """The bean's ``toString`` (``fixed.SENSOR_TEXT_FORMAT``); nulls print ``null``."""
    return F.format_string(
        SENSOR_TEXT_FORMAT,
        F.coalesce(_c(id_), F.lit("null")),
        F.coalesce(_c(ts).cast("string"), F.lit("null")),
        F.coalesce(_c(vc).cast("string"), F.lit("null")),
    )
