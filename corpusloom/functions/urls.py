"""URL helpers as SQL expressions (RFC 3986 references against http-like bases)."""

from __future__ import annotations

from corpusloom.functions.text import let, non_empty, rx

# scheme, authority, path, query, fragment
_URL = rx(r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z")
# a plain absolute path: nothing to resolve, nothing to rebuild
_PLAIN_PATH = rx(r"^/(?:[A-Za-z0-9_~%,+=&@$!*():\-]+(?:\.[A-Za-z0-9_\-]+)*/?)*\z")
_DOTS = rx(r"(?:^|/)\.\.?(?:/|\z)")
_CLOSING_DOTS = rx(r"(?:^|/)\.\.?\z")
_TO_CLEAN = rx(r"^[\x00-\x20]+|[\t\r\n]")


def clean_url(url: str) -> str:
    """Drop leading control characters and blanks, and line breaks or tabs anywhere."""
    return f"regexp_replace({url}, {_TO_CLEAN}, '')"


def split_url(url: str) -> str:
    """``struct(url, scheme, authority, path, query, fragment)``; absent parts are ''."""
    return let("u", clean_url(url), (
        f"struct({url} AS url, lower(regexp_extract(u, {_URL}, 1)) AS scheme, regexp_extract(u, {_URL}, 2) AS authority, "
        f"regexp_extract(u, {_URL}, 3) AS path, regexp_extract(u, {_URL}, 4) AS query, "
        f"regexp_extract(u, {_URL}, 5) AS fragment)"))


def authority(url: str) -> str:
    """Lower-case authority, port and user information included; '' when there is none."""
    return f"lower(regexp_extract({clean_url(url)}, {_URL}, 2))"


def is_download(url: str, extensions: tuple[str, ...]) -> str:
    suffixes = "|".join(e[1:] for e in extensions)
    return f"lower({url}) RLIKE {rx(rf'\.(?:{suffixes})\z')}"


def url_key(url: str) -> str:
    """Form used to compare a page with a fixed path: no closing slashes, lower case."""
    return f"lower(trim(TRAILING '/' FROM {url}))"


def _resolve_dots(path: str) -> str:
    kept = (f"aggregate(split({path}, '/'), cast(array() AS array<string>), (acc, s) -> "
            "CASE WHEN s = '..' THEN slice(acc, 1, greatest(size(acc) - 1, 0)) WHEN s = '.' THEN acc "
            "ELSE concat(acc, array(s)) END)")
    closing = f"CASE WHEN {path} RLIKE {_CLOSING_DOTS} THEN array('') ELSE cast(array() AS array<string>) END"
    return f"array_join(concat({kept}, {closing}), '/')"


def _unparse(host: str, path: str, query: str, fragment: str) -> str:
    return (f"concat(b.scheme, '://', {host}, "
            f"CASE WHEN {path} = '' OR startswith({path}, '/') THEN {path} ELSE concat('/', {path}) END, "
            f"CASE WHEN {query} <> '' THEN concat('?', {query}) ELSE '' END, "
            f"CASE WHEN {fragment} <> '' THEN concat('#', {fragment}) ELSE '' END)")


def make_abs(base: str, ref: str) -> str:
    """Resolve ``ref`` against ``base``, a struct made by :func:`split_url`.

    An empty reference is the base itself; a reference with another scheme
    (``mailto:``, ``https:`` seen from ``http:``) is returned as it stands.
    """
    folder = f"coalesce({non_empty('regexp_extract(b.path, ' + rx('(?s)^(.*/)') + ', 1)')}, '/')"
    joined = (f"CASE WHEN startswith(r.path, '/') THEN r.path "
              f"ELSE regexp_replace(concat({folder}, r.path), '/{{2,}}', '/') END")
    resolved = let("p", joined, f"CASE WHEN p RLIKE {_DOTS} THEN {_resolve_dots('p')} ELSE p END")
    relative = let("q", f"coalesce({non_empty(resolved)}, '/')",
                   _unparse("b.authority", "q", "r.query", "r.fragment"))
    same_path = let("q", f"coalesce({non_empty('r.query')}, b.query)",
                    _unparse("b.authority", "b.path", "q", "r.fragment"))
    full = let("r", split_url("f"), (
        f"CASE WHEN r.scheme <> '' AND r.scheme <> b.scheme THEN f "
        f"WHEN r.authority <> '' THEN {_unparse('r.authority', 'r.path', 'r.query', 'r.fragment')} "
        f"WHEN r.path = '' THEN {same_path} ELSE {relative} END"))
    return let("b", base, let("f", ref, (
        f"CASE WHEN coalesce(f, '') = '' THEN b.url "
        f"WHEN f RLIKE {_PLAIN_PATH} AND b.authority <> '' THEN concat(b.scheme, '://', b.authority, f) "
        f"ELSE {full} END")))
