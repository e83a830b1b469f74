"""Visible text of HTML as column expressions.

One pattern reads markup from left to right, so that what opens first wins: a
comment mark inside a script is script, a tag inside a comment is comment.
References are decoded after that, in one pass, so ``&amp;lt;`` gives ``&lt;``.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the markup language: elements whose content is no text, and
# those whose content is text but holds no tags.
_HIDDEN = "script|style|iframe|noembed|noframes"
_PLAIN = "title|textarea"
#: The rest of a tag: quotes count after ``=`` only; a tag without end runs to the end of the text.
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+(?:>|\z)"""
_MARKUP = "|".join([
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))",
    rf"<({_HIDDEN})(?=[\s/>]){_REST}.*?(?:</\1(?=[\s/>]){_REST}|\z)",
    rf"<({_PLAIN})(?=[\s/>]){_REST}(.*?)(?:</\2(?=[\s/>]){_REST}|\z)",
    rf"</?[a-z]{_REST}",
    r"<(?:[!?]|/[^a-z])[^>]*+(?:>|\z)|</>",
])


def _named() -> dict[str, dict[str, str]]:
    """Named references by first letter."""
    out: dict[str, dict[str, str]] = {}
    for name, value in html5.items():
        out.setdefault(name[0], {})[name] = value
    return out


#: References that also count without a semicolon, and their longest name.
_BARE = {name: value for name, value in html5.items() if not name.endswith(";")}
_LONGEST = max(map(len, _BARE))
#: Numbers 128 to 159 mean the characters of a Windows code page; the five that it lacks mean themselves.
_WINDOWS = {str(b): bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)}
_REPLACEMENT = "�"


def _table(values: dict, kind: str) -> Column:
    """A literal map; the optimiser folds it once."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _character(code: Column) -> Column:
    """Text of a numeric reference.  Control characters and code points that are
    no characters give nothing; 0, surrogates and too large numbers U+FFFD."""
    low = code.bitwiseAND(0xFFFF)
    none = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127)
            | code.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE))
    bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    spelled = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (F.when(bad, F.lit(_REPLACEMENT)).when(none, F.lit(""))
            .when(code.between(128, 159), F.try_element_at(_table(_WINDOWS, "map<string,string>"), code.cast("string")))
            .otherwise(spelled))


def _numeric(digits: Column, base: int, most: int) -> Column:
    """Number of a run of digits; beyond ``most`` significant ones too large for any character."""
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.when(F.length(short) > most, F.lit(0x110000)).otherwise(F.conv(F.left(short, F.lit(most)), base, 10)).cast("long")


def _reference(part: Column) -> Column:
    """``part`` followed an ampersand: its reference decoded, or the ampersand again."""
    decimal = F.regexp_extract(part, r"^#([0-9]+)", 1)
    hexadecimal = F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]+)", 1)
    after = F.regexp_replace(part, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", "")
    name = F.regexp_extract(part, r"^[^\t\n\f <&#;]{1,32};?", 0)
    whole = F.try_element_at(F.try_element_at(_table(_named(), "map<string,map<string,string>>"), F.left(name, F.lit(1))), name)
    bare = _table(_BARE, "map<string,string>")
    found = [F.concat(whole, F.substr(part, F.length(name) + 1))]
    for n in range(_LONGEST, 1, -1):
        found.append(F.concat(F.try_element_at(bare, F.left(name, F.lit(n))), F.substr(part, F.lit(n + 1))))
    return (F.when(decimal != "", F.concat(_character(_numeric(decimal, 10, 7)), after))
            .when(hexadecimal != "", F.concat(_character(_numeric(hexadecimal, 16, 6)), after))
            .otherwise(F.coalesce(*found, F.concat(F.lit("&"), part))))


def unescape(text: Column | str) -> Column:
    """Named, decimal and hexadecimal references decoded, with the rules of the
    markup language for missing semicolons and for numbers that are no
    characters.  Null gives null."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), _reference)
    return F.when(F.contains(text, F.lit("&")), F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(text)


def html_to_text(html: Column | str) -> Column:
    """Text without markup, references decoded, runs of blanks (no-break ones
    too) made one.

    Each tag or comment parts words.  Hidden elements go with their content;
    tags in a title or a text area are text.  Comments, tags and hidden elements
    that never end run to the end of the text; a ``<`` that opens nothing stays.
    Null gives null, an empty text the empty text."""
    html = F.col(html) if isinstance(html, str) else html
    shown = unescape(F.regexp_replace(html, _MARKUP, " $3 "))
    return F.trim(F.regexp_replace(shown, r"[\s ]+", " "))
