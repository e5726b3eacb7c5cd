"""Text functions: delimiter search, byte lengths, blank test, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a word, and characters a chunk should end with.
WORD_DELIMITERS = " .,;:!?-—\t\n\r\f\v"
PREFERRED_DELIMITERS = ".!?\n"

UTF8_NAMES = ("utf-8", "utf8")


def char_class(characters: str, negate: bool = False) -> str:
    """A Java regular-expression class of exactly the given characters."""
    members = "".join(f"\\x{{{ord(c):X}}}" for c in dict.fromkeys(characters))
    return f"[{'^' if negate else ''}{members}]"


# A regular expression turns its whole input into a Java string first.  Most answers lie
# within this many characters of one end, so a short slice is asked before the text.
_NEAR = 256


def _first(text: Column) -> Column:
    return F.substring(text, 1, _NEAR)


def _last(text: Column) -> Column:
    return F.substring(text, -_NEAR, _NEAR)


def _holds(text: Column, delimiters: str) -> Column:
    return text.rlike(char_class(delimiters))


def _before_first(text: Column, delimiters: str) -> Column:
    return F.regexp_extract(text, rf"\A{char_class(delimiters, negate=True)}*+", 0)


def _after_last(text: Column, delimiters: str) -> Column:
    # Reversing first keeps the search anchored, so a long run without a delimiter costs
    # one pass instead of one pass per character.
    return F.reverse(_before_first(F.reverse(text), delimiters))


def has_any(text: Column, delimiters: str) -> Column:
    """True when the text holds at least one of the delimiters."""
    if not delimiters:
        return F.lit(False)
    return _holds(_last(text), delimiters) | _holds(text, delimiters)


def head_run(text: Column, delimiters: str) -> Column:
    """The text before the first delimiter; the whole text if there is none."""
    if not delimiters:
        return text
    near = _first(text)
    return F.when(_holds(near, delimiters), _before_first(near, delimiters)).otherwise(
        _before_first(text, delimiters)
    )


def tail_run(text: Column, delimiters: str) -> Column:
    """The text after the last delimiter; the whole text if there is none."""
    if not delimiters:
        return text
    near = _last(text)
    return F.when(_holds(near, delimiters), _after_last(near, delimiters)).otherwise(
        _after_last(text, delimiters)
    )


def index_any(
    text: Column,
    characters: str,
    start: int | None = None,
    end: int | None = None,
    reverse: bool = False,
) -> Column:
    """Index of the first (or last) character of the set inside ``[start, end)``, else -1."""
    if not characters:
        return F.when(text.isNull(), F.lit(None)).otherwise(F.lit(-1)).cast("int")
    low = 0 if start is None else start
    size = F.length(text)
    high = size if end is None else F.least(size, F.lit(end))
    part = F.substring(text, F.lit(low + 1), F.greatest(high - low, F.lit(0)))
    found = (
        low + F.length(part) - F.length(tail_run(part, characters)) - 1
        if reverse
        else low + F.length(head_run(part, characters))
    )
    return F.when(has_any(part, characters), found).otherwise(F.lit(-1)).cast("int")


def index_any_item(
    items: Column,
    wanted: Column,
    start: int | None = None,
    end: int | None = None,
    reverse: bool = False,
) -> Column:
    """``index_any`` for arrays: position of the first (or last) element in ``wanted``."""
    low = 0 if start is None else start
    size = F.size(items)
    high = size if end is None else F.least(size, F.lit(end))
    hits = F.transform(
        F.slice(items, F.lit(low + 1), F.greatest(high - low, F.lit(0))),
        lambda item: F.array_contains(wanted, item),
    )
    if reverse:
        at = F.array_position(F.reverse(hits), True)
        index = high - at
    else:
        at = F.array_position(hits, True)
        index = low + at - 1
    empty = (size == 0) | (F.size(wanted) == 0)
    return F.when(empty | (at == 0), F.lit(-1)).otherwise(index).cast("int")


def byte_length(text: Column, encoding: str = "utf-8") -> Column:
    """Length in bytes of the encoded text."""
    if encoding.lower() in UTF8_NAMES:
        return F.octet_length(text)
    return F.octet_length(F.encode(text, encoding.upper()))


def is_blank(text: Column) -> Column:
    """True for non-empty text of Unicode white space only."""
    blank = r"(?U)\A[\s\x1c-\x1f]++\z"
    return _first(text).rlike(blank) & text.rlike(blank)


def single_line(text: Column) -> Column:
    """Newlines replaced by spaces, as embedding models prefer."""
    return F.replace(text, F.lit("\n"), F.lit(" "))


def vector_id(prefix: Column, start: Column, end: Column) -> Column:
    """Deterministic id ``prefix:start-end`` of a chunk."""
    return F.concat(prefix, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))
