"""JSON-LD objects of a page."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.functions import dom as D
from corpusloom.functions import variants as V
from corpusloom.functions.text import let
from corpusloom.sources.shred import Needs

_SCRIPTS = D.select("dom", "n.tag = 'script' AND " + D.attr_like("type", r"application/ld\+json"))
# The nodes metadata is read from; everything in the head needs only these.
MARKS = D.select("dom", D.tag_in("title", "meta", "link"))
# One list of objects per script; a script that is not JSON has none.
_OBJECTS = f"transform({_SCRIPTS}, n -> {let('v', V.tolerant_json(D.raw_text('n')), V.top_level_objects('v'))})"

JSONLD = f"flatten({_OBJECTS})"
#: What JSON-LD is read from.
JSONLD_NEEDS = Needs(scripts=frozenset([r"application/ld\+json"]), attrs=frozenset(["type"]))


def with_jsonld(pages: DataFrame) -> DataFrame:
    """Add ``jsonld``, all JSON-LD objects of the page in document order."""
    return pages if "jsonld" in pages.columns else D.add(pages, jsonld=JSONLD)


def extract_jsonld(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per object: ``(page_id, script_pos, obj_pos, obj)``."""
    scripts = D.item_rows(pages, key, _OBJECTS, "script_pos", "objs")
    return D.item_rows(scripts, (key, "script_pos"), "objs", "obj_pos", "obj")


def flatten_types(jsonld: str) -> str:
    """All ``@type`` names of the objects, in order."""
    return f"flatten(transform({jsonld}, o -> {V.type_names('o')}))"
