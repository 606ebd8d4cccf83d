"""Value-level column helpers: keys, NULL handling, recoding, JSON, strings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def key_part(col, i: int, sep: str = "#") -> Column:
    """Part ``i`` (0-based) of a composite key; NULL when the key is short.

    ``split`` takes a regex, so the separator is quoted.  ``get`` returns
    NULL out of range where ``[]`` raises under ANSI.
    """
    return F.get(F.split(_c(col), _regex_quote(sep)), i)


def split_key(df: DataFrame, col: str, names: Sequence[str], sep: str = "#") -> DataFrame:
    """``org#region#site`` → one column per part (NULL when missing)."""
    parts = F.split(F.col(col), _regex_quote(sep))
    return df.select("*", *[F.get(parts, i).alias(n) for i, n in enumerate(names)])


def _regex_quote(s: str) -> str:
    return "".join("\\" + c if c in r".^$*+?{}[]\|()" else c for c in s)


def least_strict(*cols) -> Column:
    """LEAST that returns NULL when any input is NULL (Spark's skips NULLs)."""
    cs = [_c(c) for c in cols]
    anynull = cs[0].isNull()
    for c in cs[1:]:
        anynull = anynull | c.isNull()
    return F.when(~anynull, F.least(*cs))


def greatest_strict(*cols) -> Column:
    """GREATEST that returns NULL when any input is NULL."""
    cs = [_c(c) for c in cols]
    anynull = cs[0].isNull()
    for c in cs[1:]:
        anynull = anynull | c.isNull()
    return F.when(~anynull, F.greatest(*cs))


def blank_to_null(col) -> Column:
    """Trimmed text, NULL when empty."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (SAFE_DIVIDE)."""
    return F.try_divide(_c(num), _c(den))


def hex_to_long(col) -> Column:
    """Hex text → bigint, NULL for non-hex text (``conv`` alone gives 0)."""
    c = _c(col)
    return F.when(c.rlike("^[0-9A-Fa-f]+$"), F.conv(c, 16, 10).cast("bigint"))


def contains_ci(col, needle: str) -> Column:
    """Case-insensitive substring test (CONTAINS_SUBSTR)."""
    return F.contains(F.lower(_c(col)), F.lit(needle.lower()))


def recode(col, mapping: Mapping[str, Iterable[str]], default=None, lower: bool = True) -> Column:
    """Map free text onto labels: ``{label: [variants]}``, first match wins.

    Comparison is on lower-cased text when ``lower``.  Unmatched values keep
    the input (``default=None``) or take ``default``.
    """
    src = F.lower(_c(col)) if lower else _c(col)
    expr = None
    for label, variants in mapping.items():
        vs = [v.lower() if lower else v for v in variants]
        cond = src.isin(vs)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = _c(col) if default is None else F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def json_text(col, path: str) -> Column:
    """Scalar at a JSON path as text (JSON_VALUE / JSON_EXTRACT_SCALAR)."""
    return F.get_json_object(_c(col), path)


def json_raw(col, path: str) -> Column:
    """JSON_EXTRACT: the JSON text at ``path`` -- string values keep their quotes.

    Parsed once into a VARIANT (``try_parse_json``: invalid text → NULL) and
    re-serialised, so strings, numbers, arrays and objects all come back as
    JSON text.
    """
    v = F.try_variant_get(F.try_parse_json(_c(col)), path, "variant")
    return F.to_json(v)


def with_timezone(df: DataFrame, org_col: str, mapping: DataFrame, patterns: list[tuple[str, str]] | None = None,
                  name: str = "timezone") -> DataFrame:
    """Organisation → time zone; unknown organisations get NULL (as the CASE does).

    ``mapping`` (columns ``org``, ``timezone``) is a lookup table: an equi
    left join that the planner broadcasts by its size.  ``patterns`` are
    ordered ``(like_pattern, zone)`` pairs tried first -- order matters when
    one prefix contains another (``abc%`` before ``ab%``).
    """
    m = mapping.select(F.col("org").alias("__org"), F.col("timezone").alias("__tz"))
    out = df.join(m, df[org_col] == m["__org"], "left")
    tz = F.col("__tz")
    if patterns:
        expr = None
        for pat, zone in patterns:
            cond = F.col(org_col).like(pat)
            expr = F.when(cond, F.lit(zone)) if expr is None else expr.when(cond, F.lit(zone))
        tz = expr.otherwise(tz)
    return out.withColumn(name, tz).drop("__org", "__tz")
