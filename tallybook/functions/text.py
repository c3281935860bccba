"""Column expressions for labels, numbers and markup text."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All standard names ("amp;"); those of the oldest ones also count without their semicolon ("amp").
BARE_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
NUMERIC = r"^&#(?:[xX]([0-9A-Fa-f]+)|([0-9]+));?"
NAMED = r"^&([A-Za-z][A-Za-z0-9]*;)"
BARE = rf"^&({'|'.join(BARE_NAMES)})"
#: Numbers 128 to 159 mean the characters that the Windows code page has there.
WINDOWS = {code: bytes([code]).decode("cp1252") for code in range(128, 160) if code not in (129, 141, 143, 144, 157)}
# The characters counted as white space.
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def clean_number(text: Column) -> Column:
    """``'1,234.50'`` and ``'12%'`` to double; anything that is not a number to null."""
    digits = strip(F.regexp_replace(text, "[,%]", ""))
    return F.when(digits.rlike(NUMBER), digits.try_cast("double"))


def normalise_label(label: Column) -> Column:
    """Line-item text to a column name: lower case, ``_`` for spaces, no ``+``, ``percent`` for ``%``."""
    name = F.replace(F.lower(label), F.lit(" "), F.lit("_"))
    name = F.replace(F.replace(name, F.lit("+"), F.lit("")), F.lit("%"), F.lit("percent"))
    return strip(name)


COMMON_NAMES = ["amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;"]


def _map(entries: dict) -> Column:
    return F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in entries.items())), F.lit("\x02"), F.lit("\x01"))


def _named_reference(name: Column) -> Column:
    """The text of a named reference, null if there is none. A map is searched entry by entry, so there is one per
    first letter, behind the names that pages mostly use."""
    found = F
    for common in COMMON_NAMES:
        found = found.when(name == common, F.lit(html5[common]))
    names = {k: v for k, v in html5.items() if k.endswith(";")}
    first = F.substring(name, 1, 1)
    for letter in sorted({k[0] for k in names}):
        found = found.when(first == letter, F.try_element_at(_map({k: v for k, v in names.items() if k[0] == letter}), name))
    return found


def _decode_leading_reference(piece: Column) -> Column:
    digits = F.ltrim(F.regexp_extract(piece, NUMERIC, 2), F.lit("0"))
    hexes = F.ltrim(F.regexp_extract(piece, NUMERIC, 1), F.lit("0"))
    # Seven digits hold every code point; longer numbers are beyond them all.
    code = F.when(hexes != "", F.when(F.length(hexes) <= 7, F.conv(hexes, 16, 10))) \
        .otherwise(F.when(F.length(digits) <= 7, digits)).try_cast("int")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    plain = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
    numeric = F.coalesce(F.try_element_at(_map(WINDOWS), code.cast("string")), plain)
    named = _named_reference(F.regexp_extract(piece, NAMED, 1))
    bare = F.try_element_at(_map({k: html5[k] for k in BARE_NAMES}), F.regexp_extract(piece, BARE, 1))

    def rest(pattern: str) -> Column:
        return F.regexp_replace(piece, pattern, "")

    return (F.when(~piece.startswith("&"), piece)
            .when(piece.rlike(NUMERIC), F.concat(numeric, rest(NUMERIC)))
            .when(named.isNotNull(), F.concat(named, rest(NAMED)))
            .when(bare.isNotNull(), F.concat(bare, rest(BARE))).otherwise(piece))


def decode_references(text: Column) -> Column:
    """Replace named and numeric character references, each once; unknown names stay as they are."""
    pieces = F.split(text, "(?=&[#A-Za-z])")
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, _decode_leading_reference), "")) \
        .otherwise(text)


def remove_tags(html: Column) -> Column:
    """Markup without its tags. A tag may not hold ``<``, which keeps this linear."""
    return F.regexp_replace(html, "<[/!?a-zA-Z][^<>]*>", "")


def markup_text(html: Column) -> Column:
    """Visible text of a markup fragment, trimmed."""
    return strip(decode_references(remove_tags(html)))


def markup_texts(fragments: Column) -> Column:
    """``markup_text`` of every array element, one step at a time so that no step is evaluated twice."""
    texts = fragments
    for step in (remove_tags, decode_references, strip):
        texts = F.transform(texts, step)
    return texts
