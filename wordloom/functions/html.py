"""HTML to title and body text, as column expressions.

The rules follow what a browser-like text extraction gives: block elements
and line breaks separate words, inline elements do not, scripts, styles and
comments vanish, entities are decoded once, white space collapses.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .analysis import bind

# ---------------------------------------------------------------------------
# Elements that put a space around their text.
BLOCK_TAGS = (
    "html", "head", "body", "frameset", "script", "noscript", "style", "meta",
    "link", "title", "frame", "noframes", "section", "nav", "aside", "hgroup",
    "header", "footer", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol",
    "pre", "div", "blockquote", "hr", "address", "figure", "figcaption",
    "form", "fieldset", "ins", "del", "dl", "dt", "dd", "li", "table",
    "caption", "thead", "tfoot", "tbody", "colgroup", "col", "tr", "th", "td",
    "video", "audio", "canvas", "details", "menu", "plaintext", "template",
    "article", "main", "svg", "math", "center", "br",
)
# ---------------------------------------------------------------------------

# The rest of a tag after its name: a quoted value may hold ">", and a tag
# the input ends in is dropped.
_REST = r"""(?:[^>=]|=\s*+(?:"[^"]*"|'[^']*')?+)*+(?:>|\z)"""
HIDDEN = (
    rf"(?is)<script\b{_REST}.*?(?:</script\s*>|\z)"
    rf"|<style\b{_REST}.*?(?:</style\s*>|\z)"
)
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
UP_TO_BODY = rf"(?is)\A.*?<body\b{_REST}"
HEAD = rf"(?is)<head\b{_REST}.*?</head\s*>|<title\b{_REST}.*?</title\s*>"
# Tags of the outermost elements make no element of their own after the start.
_SPACED = "|".join(t for t in BLOCK_TAGS if t not in ("html", "body"))
BLOCK = rf"(?i)</?(?:{_SPACED})\b{_REST}"
OTHER_TAG = rf"(?i)</?[a-z]{_REST}|<[!?/][^>]*(?:>|\z)"
TITLE = rf"(?is)<title\b{_REST}(.*?)</title\s*>"
SPACE = "[ \\t\\n\\f\\r ]+"
INVISIBLE = "[​­]"
ENTITY = r"&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[A-Za-z]+[0-9]*);?"

_FREQUENT = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;", "copy;", "middot;")
_NAMES = {name: html5[name] for name in _FREQUENT} | html5


def _character(code: Column) -> Column:
    """Character of a code point; U+FFFD where there is none."""
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return F.when(valid, F.decode(utf32, "UTF-32")).otherwise(F.lit("�"))


def decode_entities(text: Column) -> Column:
    """Named and numeric character references, each decoded exactly once."""
    names = F.from_json(F.lit(json.dumps(_NAMES)), "map<string,string>")

    def decoded(part: Column) -> Column:
        # Leading zeros say nothing; more than nine digits without them are no character.
        digits = F.regexp_replace(part, "^&#[xX]?0*(?=[0-9a-fA-F])|;$", "")
        digits = F.when(F.length(digits) > 9, "0").otherwise(digits)
        hex_code = F.conv(digits, 16, 10).cast("bigint")
        dec_code = F.conv(digits, 10, 10).cast("bigint")
        return (
            F.when(~F.startswith(part, F.lit("&")), part)
            .when(part.rlike("^&#[xX]"), _character(hex_code))
            .when(F.startswith(part, F.lit("&#")), _character(dec_code))
            .otherwise(F.coalesce(F.try_element_at(names, F.substring(part, 2, 64)), part))
        )

    parts = F.regexp_extract_all(text, F.lit(f"{ENTITY}|[^&]+|&"), F.lit(0))
    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(parts, decoded), "")).otherwise(text)


def _tidy(text: Column) -> Column:
    return bind(
        decode_entities(text),
        lambda t: F.trim(F.regexp_replace(F.regexp_replace(t, INVISIBLE, ""), SPACE, " ")),
    )


def html_title(html: Column) -> Column:
    """Text of the first title element, empty if there is none."""
    return _tidy(F.regexp_extract(html, TITLE, 1))


def html_body_text(html: Column) -> Column:
    """Visible text of the body."""
    shown = F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), COMMENT, "")
    body = bind(
        F.regexp_replace(shown, UP_TO_BODY, ""),
        lambda b: F.regexp_replace(b, HEAD, " "),
    )
    text = F.regexp_replace(F.regexp_replace(body, BLOCK, " "), OTHER_TAG, "")
    return _tidy(text)
