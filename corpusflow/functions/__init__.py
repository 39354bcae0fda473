"""Scalar Column builders: text, URLs, flat HTML."""

from corpusflow.functions.html import html_lang, tag_text, unescape
from corpusflow.functions.text import (
    ascii_fold,
    basename,
    combined_slug,
    ellipsize,
    scraped_slug,
    slugify,
    slugify_admin,
    stem,
    strip_chars,
    swap_suffix,
    zfill_id,
)
from corpusflow.functions.urls import (
    item_identifier,
    page_slug,
    page_slug_admin,
    state_name,
    url_authority,
    url_join,
    url_path,
    url_quote,
)

__all__ = [n for n in dir() if not n.startswith("_")]
