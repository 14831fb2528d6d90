"""Everything about a site's markup and wording that a user may want to change, with its defaults."""

from __future__ import annotations

from dataclasses import dataclass

# Section names and their heading patterns, in order of precedence.
SECTION_PATTERNS = (
    ("description", (
        r"\bdescription\b", r"\bdescription\s+of\b", r"\boverview\b", r"\bintroduction\b",
        r"\babout\b", r"\bproduct\s+overview\b")),
    ("what_is", (
        r"\bwhat\s+is\b", r"\bwhat\s+is\s+this\b", r"\bdefinition\b", r"\bdefinition\s+of\b")),
    ("other_names", (
        r"\bother\s+names?\b", r"\balso\s+known\s+as\b", r"\bsynonyms?\b",
        r"\balternative\s+names?\b", r"\baka\b")),
    ("specifications", (
        r"\bspecification(s)?\b", r"\btechnical\s+data\b", r"\btechnical\s+specs?\b",
        r"\bproduct\s+data\b", r"\btypical\s+properties\b", r"\bphysical\s+properties\b",
        r"\bchemical\s+properties\b", r"\bgrades?\b")),
    ("applications_uses", (
        r"\bapplications?\s+and\s+uses\b", r"\bapplications?\b", r"\buses\b", r"\busage\b",
        r"\bfields?\s+of\s+application\b", r"\bindustr(y|ies)\b", r"\bwhere\s+to\s+use\b")),
    ("packing", (
        r"\bpacking\b", r"\bpackaging\b", r"\bavailable\s+packing\b", r"\bpacking\s+type\b",
        r"\bpacking\s+and\s+storage\b", r"\bpackaging\s+and\s+storage\b", r"\bpacking\s+and\s+delivery\b")),
)


@dataclass(frozen=True)
class Rules:
    """Fixed values of the extractors; pass a changed copy (``dataclasses.replace``) to adapt a site."""

    # JSON-LD types (lower case) by page type, the listing page that is never a product, card markup
    article_types: tuple[str, ...] = ("article", "newsarticle", "blogposting")
    collection_types: tuple[str, ...] = ("collectionpage", "itemlist")
    listing_path: str = "/products"
    card_classes: tuple[str, ...] = ("post-card", "archive-item", "product-card", "entry", "card",
                                     "elementor-post", "elementor-grid-item")
    cards_needed: int = 3
    # class names of article bodies
    theme_content: str = "elementor-widget-theme-post-content"
    entry_content: str = "entry-content"
    single_post: str = "single-post"
    # markup that never counts as content
    boilerplate_tags: tuple[str, ...] = ("form", "nav", "header", "footer", "aside")
    boilerplate_classes: tuple[str, ...] = ("comments-area", "comment-form", "site-footer", "widget-area",
                                            "entry-footer", "wp-block-comments", "pagination")
    boilerplate_ids: tuple[str, ...] = ("comments",)
    # shortest text that counts as a block
    min_block: int = 40
    min_list_item: int = 20
    # link suffixes that count as downloads
    download_extensions: tuple[str, ...] = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".csv", ".zip")
    section_patterns: tuple[tuple[str, tuple[str, ...]], ...] = SECTION_PATTERNS


DEFAULTS = Rules()
