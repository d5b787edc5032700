"""Row-level cleaning of text columns, all built-in expressions (no Python in the tasks)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space, so that trimming does not stop at U+0020 as Spark's one-argument trim does.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"[\t\n\f\r ]+"
FIVE_DIGITS = r"^[0-9]{5}\z"
# an integer, perhaps followed by a dangling dash and then by ".0"; anything else has no number,
# so the cast below never meets text it would have to fail on
ZIP_NUMBER = r"^[+-]?[0-9]+(?=-?(\.0)?\z)"


def trim(c: Column) -> Column:
    """Strip all leading and trailing whitespace."""
    return F.btrim(c, F.lit(WHITESPACE))


def squeeze(c: Column) -> Column:
    """Turn whitespace runs into one space."""
    return F.regexp_replace(c, SPACE_RUN, " ")


def normalize_name(c: Column, punct: str = ".,;") -> Column:
    """Upper-case, squeeze whitespace, then strip trailing punctuation."""
    return F.rtrim(squeeze(F.upper(trim(c))), F.lit(punct))


def clean_code(c: Column, aliases: Mapping[str, str], max_len: int, missing: str) -> Column:
    """Upper-cased short code; long forms go through `aliases`, other long values become `missing`."""
    code = F.upper(trim(c))
    out = F.when(code.isNull(), missing)
    for long_form, short in aliases.items():
        out = out.when(code == long_form, short)
    return out.when(F.length(code) > max_len, missing).otherwise(code)


def clean_zip(c: Column, keep_privacy_prefix: bool = False) -> Column:
    """Repair float-formatted and half-typed postcodes; unparseable values stay as they are.

    Three-digit privacy prefixes are zero-padded to five digits by default;
    `keep_privacy_prefix` keeps integers 1-999 as three digits instead.
    """
    raw = trim(c)
    number = F.regexp_substr(raw, F.lit(ZIP_NUMBER)).try_cast("bigint")
    digits = number.cast("string")
    padded = F.lpad(digits, 5, "0")
    if keep_privacy_prefix:
        padded = F.when(number.between(1, 999), F.lpad(digits, 3, "0")).otherwise(padded)
    return F.coalesce(padded, raw)


def zip_is_valid(c: Column) -> Column:
    return F.coalesce(c.rlike(FIVE_DIGITS), F.lit(False))


def tag_flag(c: Column, tag: str) -> Column:
    """True when a delimited tag string mentions `tag`; a missing string is False."""
    return F.coalesce(c.contains(tag), F.lit(False))


def fill_missing(c: Column, value: str) -> Column:
    """Trim; NULL (but not a blank) becomes `value`."""
    return F.coalesce(trim(c), F.lit(value))


def relabel(c: Column, labels: Mapping[str, str], missing: str) -> Column:
    """Trim, rewrite the listed labels, and name missing values."""
    value = trim(c)
    out = F.when(c.isNull(), missing)
    for old, new in labels.items():
        out = out.when(value == old, new)
    return out.otherwise(value)


def display_name(c: Column, replacements: Sequence[tuple[str, str]], drop_suffix: str = "") -> Column:
    """Readable holder name: ordered literal replacements on the squeezed upper-case name."""
    name = reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), replacements,
                  squeeze(F.upper(trim(c))))
    if not drop_suffix:
        return name
    return F.when(name.endswith(drop_suffix), F.left(name, F.length(name) - len(drop_suffix))).otherwise(name)


def strip_legal_suffixes(c: Column, suffixes: Sequence[str]) -> Column:
    """Remove each legal suffix (with its separating comma) from the end, in the given order."""
    stripped = reduce(lambda acc, s: F.regexp_replace(acc, rf",?\s*{s}\z", ""), suffixes, F.upper(trim(c)))
    return trim(stripped)


def classify_regex(c: Column, rules: Sequence[tuple[str, str]], default: str | None) -> Column:
    """Label of the first (label, pattern) rule that matches anywhere in the value."""
    out = None
    for label, pattern in rules:
        hit = c.rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def zip_pattern(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Shape of a postcode: null, empty, one of the rules, or other."""
    return (F.when(c.isNull(), "null").when(c == "", "empty_string")
            .otherwise(classify_regex(c, rules, "other")))


def categorize(c: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Literal value map; values that share a label become one IN-list."""
    out = None
    for label in dict.fromkeys(mapping.values()):
        hit = c.isin([value for value, to in mapping.items() if to == label])
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def presence_flag(c: Column) -> Column:
    return c.isNotNull()
