"""String and list helpers.

The helpers of this package take and return SQL expression text, to be used in
``F.expr`` and inside ``transform`` / ``filter`` lambdas; Catalyst sees one
declarative expression per operator.
"""

from __future__ import annotations

# Every character Python counts as whitespace, spelled out because Java's \s stops at ASCII.
WS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"

NO_STRINGS = "cast(array() AS array<string>)"


def lit(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rx(pattern: str) -> str:
    """A regular expression as a raw literal."""
    if "'" in pattern:
        raise ValueError("quote in pattern")
    return f"r'{pattern}'"


def let(name: str, value: str, body: str) -> str:
    """Bind ``value`` once under ``name`` and use it several times in ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def first(items: str) -> str:
    """First item, null when there is none."""
    return f"get({items}, 0)"


def normalize_ws(s: str) -> str:
    """Collapse runs of whitespace to one blank and trim; null gives ''."""
    return f"trim(regexp_replace(coalesce({s}, ''), {rx(WS + '+')}, ' '))"


def strip(s: str) -> str:
    """Drop leading and trailing whitespace of any kind."""
    return f"regexp_replace({s}, {rx(f'^{WS}+|{WS}+' + chr(92) + 'z')}, '')"


def non_empty(s: str) -> str:
    """The string, or null when it is empty."""
    return f"nullif({s}, '')"


def falsy_coalesce(*values: str) -> str:
    """First non-empty string; when none is, whatever the last one holds."""
    return "coalesce(" + ", ".join([*map(non_empty, values[:-1]), values[-1]]) + ")"


def split_trim(s: str, separator: str = ",") -> str:
    """Split, strip every part and drop the empty ones."""
    return f"filter(transform(split({s}, '{separator}'), w -> {strip('w')}), w -> w <> '')"


def sha256_hex(s: str) -> str:
    return f"sha2({s}, 256)"


def normalize_heading(s: str) -> str:
    """Lower-case heading text without closing punctuation."""
    closing = r"[:?؛،.\-]+\z"
    return f"trim(regexp_replace(lower({normalize_ws(s)}), {rx(closing)}, ''))"
