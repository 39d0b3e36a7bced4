"""Column expressions shared by the loaders and cleaning steps (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII punctuation as Python's string.punctuation defines it.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Fixed value: the ordinal-suffix pattern used to read an edition number.
EDITION_PATTERN = r"(\d+)(?:st|nd|rd|th)"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c) -> Column:
    """Cypher ``toInteger`` on text: parse as a number, truncate, null when not numeric.

    Going through double keeps '2023.0' (a pandas float written to CSV) valid.
    """
    return col_of(c).try_cast("double").try_cast("bigint")


def to_float(c) -> Column:
    return col_of(c).try_cast("double")


def split_list(c, delimiter: str = ",", trim: bool = True) -> Column:
    """``split(s, d)`` with the delimiter taken literally, optionally trimming items."""
    import re

    parts = F.split(col_of(c), re.escape(delimiter))
    return F.transform(parts, lambda x: F.trim(x)) if trim else parts


def strip_punctuation(c) -> Column:
    """Remove ASCII punctuation (explicit class so Java regex and RE2 agree)."""
    import re

    return F.regexp_replace(col_of(c), "[" + re.escape(ASCII_PUNCTUATION) + "]", "")


def extract_edition(c) -> Column:
    """First number followed by st/nd/rd/th, or null (pandas ``str.extract``)."""
    return F.nullif(F.regexp_extract(col_of(c), EDITION_PATTERN, 1), F.lit(""))


def parse_list_literal(c, fail_on_bad: bool = False) -> Column:
    """Text of a Python list literal (``"['a', 'b']"``) to array<string>.

    Quotes of either kind, escapes and numbers parse as JSON with single
    quotes allowed.  ``None`` outside quotes reads as null; the escapes
    ``\\xNN`` and ``\\UNNNNNNNN`` become ``\\uNNNN`` (one or two).  Text that is no list
    gives null, or an error with ``fail_on_bad``.
    """
    opts = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    quoted = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
    json = F.regexp_replace(col_of(c), rf"\bNone\b(?=(?:[^'\"]|{quoted})*$)", "null")
    odd = r"(?<!\\)((?:\\\\)*)"
    json = F.regexp_replace(json, odd + r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    json = F.regexp_replace(json, odd + r"\\U0000([0-9a-fA-F]{4})", r"$1\\u$2")
    json = _with_surrogates(json, odd)
    parsed = F.from_json(json, "array<string>", opts)
    if fail_on_bad:
        bad = F.raise_error(F.concat(F.lit("not a list literal: "), col_of(c))).cast("array<string>")
        parsed = F.when(col_of(c).isNotNull() & parsed.isNull(), bad).otherwise(parsed)
    return parsed


def _with_surrogates(text: Column, before: str) -> Column:
    """Escapes \\UNNNNNNNN above U+FFFF as the two \\uNNNN that JSON writes."""
    escape = before + r"\\U(00(?:0[1-9a-fA-F]|10)[0-9a-fA-F]{4})"
    parts = F.split(F.regexp_replace(text, escape, "$1\ue002$2\ue002"), "\ue002")

    def pair(digits: Column) -> Column:
        rest = F.conv(digits, 16, 10).cast("int") - 0x10000
        return F.concat(*[F.concat(F.lit("\\u"), F.lower(F.hex(half))) for half in (
            F.shiftright(rest, 10) + 0xD800, rest.bitwiseAND(F.lit(0x3FF)) + 0xDC00)])

    # odd places hold the digits of an escape
    joined = F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, pair(x)).otherwise(x)), "")
    return F.when(F.regexp_like(text, F.lit(escape)), joined).otherwise(text)


def hash_draw(*cols, seed: str = "") -> Column:
    """Seeded, partition-independent draw in [0, 2^60): first 15 hex digits of md5."""
    key = F.concat_ws("|", F.lit(seed), *[col_of(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")
