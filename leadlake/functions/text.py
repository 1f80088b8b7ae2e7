"""Text cleaning and column-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blank characters stripped by ``trim_blanks`` -- the Unicode
# space separators (category Zs): U+0020, U+00A0, U+1680, U+2000..U+200A,
# U+202F, U+205F, U+3000. Tab and newline are kept, as the warehouse trim does.
BLANKS = ("\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u202f\u205f\u3000")

# The safe-name rewrite, in order -- lower-case, then
# ' ' -> '_', '&' -> 'and', '-' -> '_', '/' -> '_', and drop . , ( ) ' "
SAFE_NAME_STEPS = [(" ", "_"), ("&", "and"), ("-", "_"), ("/", "_"),
                   (".", ""), (",", ""), ("(", ""), (")", ""), ("'", ""), ('"', "")]


def trim_blanks(c: Column | str) -> Column:
    """Strip leading/trailing space separators (not only U+0020)."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS))


def clean_text(c: Column | str) -> Column:
    """``nullif(trim(cast(c as string)), '')``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(trim_blanks(col.cast("string")), F.lit(""))


def safe_name(prefix: str, value: str) -> str:
    """Column name for a one-hot level: ``prefix__value`` made identifier-safe."""
    name = f"{prefix}__{value}".lower()
    for old, new in SAFE_NAME_STEPS:
        name = name.replace(old, new)
    return name


def safe_name_col(prefix: str, value: Column | str) -> Column:
    """The same rewrite as ``safe_name`` as a column expression."""
    col = F.col(value) if isinstance(value, str) else value
    out = F.lower(F.concat(F.lit(f"{prefix}__"), col))
    for old, new in SAFE_NAME_STEPS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out
