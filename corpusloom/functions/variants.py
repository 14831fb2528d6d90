"""JSON values (``VARIANT``) with the type tests JSON-LD needs, as SQL expressions."""

from __future__ import annotations

from corpusloom.functions.text import NO_STRINGS, let, strip

NO_VARIANTS = "cast(array() AS array<variant>)"


def is_object(v: str) -> str:
    return f"startswith(schema_of_variant({v}), 'OBJECT<')"


def is_array(v: str) -> str:
    return f"startswith(schema_of_variant({v}), 'ARRAY<')"


def is_string(v: str) -> str:
    return f"schema_of_variant({v}) = 'STRING'"


def member(v: str, key: str) -> str:
    """Value under ``key`` of an object, null when absent."""
    return f"try_variant_get({v}, '$[\"{key}\"]', 'variant')"


def as_string(v: str) -> str:
    """The text of a JSON string, null for every other JSON value."""
    return f"CASE WHEN {is_string(v)} THEN cast({v} AS string) END"


def string_member(v: str, key: str) -> str:
    return let("sm", member(v, key), as_string("sm"))


def items(v: str) -> str:
    """The elements of a JSON array, no elements for every other JSON value."""
    return f"CASE WHEN {is_array(v)} THEN try_variant_get({v}, '$', 'array<variant>') ELSE {NO_VARIANTS} END"


def one_value(text: str) -> str:
    """The value of a text that is one whole JSON value, null when anything follows it.

    The parser stops after the first value. As the first of two members of a list, with the text's own digest as
    the second, the text has to end where its value ends.
    """
    pair = f"try_parse_json(concat('[', {text}, ',\"', mark, '\"]'))"
    return let("mark", f"md5({text})", let("pair", pair, (
        "CASE WHEN try_variant_get(pair, '$[1]', 'string') = mark AND try_variant_get(pair, '$[2]', 'variant') IS NULL "
        "THEN try_variant_get(pair, '$[0]', 'variant') END")))


def _without_nan(text: str) -> str:
    """``NaN`` and infinities outside strings become ``null``; quoted parts are told by their place between quotes."""
    masked = f"replace(replace({text}, '\\\\\\\\', '\\uE000'), '\\\\\"', '\\uE001')"
    parts = f"transform(split({masked}, '\"', -1), (s, i) -> CASE WHEN i % 2 = 0 THEN regexp_replace(s, '-?Infinity|NaN', 'null') ELSE s END)"
    return f"replace(replace(array_join({parts}, '\"'), '\\uE001', '\\\\\"'), '\\uE000', '\\\\\\\\')"


def tolerant_json(raw: str) -> str:
    """Parse a text that is one JSON value; on failure without byte-order marks, then with ``NaN`` and infinities as null."""
    bare = "replace(t, '\\uFEFF', '')"
    return let("t", strip(raw), f"coalesce({one_value('t')}, {let('t', strip(bare), one_value('t'))}, {let('t', strip(bare), let('u', _without_nan('t'), one_value('u')))})")


def top_level_objects(v: str) -> str:
    """Objects of one JSON-LD script: a graph's members, the object itself, or an array's members."""
    found = let("g", member(v, "@graph"), (
        f"CASE WHEN {is_object(v)} AND {is_array('g')} THEN {items('g')} "
        f"WHEN {is_object(v)} THEN array({v}) ELSE {items(v)} END"))
    return f"filter(coalesce({found}, {NO_VARIANTS}), o -> {is_object('o')})"


def type_names(v: str) -> str:
    """Values of ``@type``, a string or a list, stripped, empty ones dropped."""
    names = let("ty", member(v, "@type"), (
        f"CASE WHEN {is_string('ty')} THEN array(cast(ty AS string)) "
        f"ELSE transform({items('ty')}, x -> cast(x AS string)) END"))
    return f"transform(filter(coalesce({names}, {NO_STRINGS}), x -> x <> ''), x -> {strip('x')})"


def plain_type(v: str) -> str:
    """Lower-case ``@type`` when it is a plain string, '' otherwise."""
    return f"lower(coalesce({string_member(v, '@type')}, ''))"
