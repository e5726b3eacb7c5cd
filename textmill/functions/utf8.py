"""UTF-8 boundary functions over BINARY columns.

All but ``continuation_bytes`` look at the hexadecimal form of at most a handful of bytes
at one end of the value, so they cost the same for a 64-byte chunk and for a 1 MiB one.
Only input that cannot be UTF-8 (four or more continuation bytes in a row) takes the slow
branch that reads the whole value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest UTF-8 character, and two hex digits of a byte 10xxxxxx.
MAX_CHARACTER_BYTES = 4
_CONTINUATION = "[89AB]."
# A complete character at the end of the value, by the length its first byte announces.
_COMPLETE_AT_END = (
    f"(?:[0-7].|[CD].{_CONTINUATION}|E.(?:{_CONTINUATION}){{2}}|F[0-7](?:{_CONTINUATION}){{3}})$"
)


def byte_range(data: Column, start: Column | int, length: Column | int) -> Column:
    """``length`` bytes of a BINARY value from the zero-based byte ``start``."""
    return F.substring(data, F.lit(start).cast("int") + 1, F.lit(length).cast("int"))


def is_continuation_byte(byte: Column) -> Column:
    """True for an integer byte of the form 10xxxxxx."""
    return byte.bitwiseAND(F.lit(0b11000000)) == F.lit(0b10000000)


def _leading_run(data: Column) -> Column:
    # The prefix must stay aligned to whole bytes, hence the anchor at the very start.
    return (F.length(F.regexp_extract(F.hex(data), f"^(?:{_CONTINUATION})*", 0)) / 2).cast("int")


def _trailing_run(data: Column) -> Column:
    # Hex has even length and the match ends at "$", so pairs are whole bytes here too.
    return (F.length(F.regexp_extract(F.hex(data), f"(?:{_CONTINUATION})*$", 0)) / 2).cast("int")


def leading_continuation_bytes(data: Column) -> Column:
    """Number of continuation bytes at the start of the value."""
    near = _leading_run(byte_range(data, 0, MAX_CHARACTER_BYTES))
    return F.when(near < MAX_CHARACTER_BYTES, near).otherwise(_leading_run(data))


def continuation_bytes(data: Column) -> Column:
    """Number of continuation bytes anywhere in the value.

    Latin-1 shows every byte as one character, so one regular expression leaves those that
    ``is_continuation_byte`` accepts; no array has an item per byte.
    """
    accepted = F.filter(F.sequence(F.lit(0), F.lit(255)), is_continuation_byte)
    characters = F.array_join(F.transform(accepted, lambda byte: F.char(byte)), "")
    others = F.concat(F.lit("[^"), characters, F.lit("]+"))
    return F.length(F.regexp_replace(F.decode(data, "ISO-8859-1"), others, F.lit("")))


def _last_bytes(data: Column) -> Column:
    size = F.octet_length(data)
    return byte_range(data, F.greatest(size - (MAX_CHARACTER_BYTES + 1), F.lit(0)), MAX_CHARACTER_BYTES + 1)


def trailing_continuation_bytes(data: Column) -> Column:
    """Number of continuation bytes at the end of the value."""
    near = _trailing_run(_last_bytes(data))
    return F.when(near <= MAX_CHARACTER_BYTES, near).otherwise(_trailing_run(data))


def truncation_point(data: Column) -> Column:
    """Byte index of an incomplete last character, or the length if there is none.

    A value of continuation bytes only gives 0.  The rest of the value is not checked.
    More than three continuation bytes behind another byte cannot be UTF-8: NULL.
    """
    size = F.octet_length(data)
    near = _trailing_run(_last_bytes(data))
    return (
        F.when(near == size, F.lit(0))
        .when(F.hex(_last_bytes(data)).rlike(_COMPLETE_AT_END), size)
        .when(near < MAX_CHARACTER_BYTES, size - near - 1)
        .when(_trailing_run(data) == size, F.lit(0))
    )


def lstrip_continuation_bytes(data: Column) -> Column:
    """The value without its leading continuation bytes."""
    return byte_range(data, leading_continuation_bytes(data), F.octet_length(data))


def rstrip_continuation_bytes(data: Column) -> Column:
    """The value without its trailing continuation bytes."""
    return byte_range(data, 0, F.octet_length(data) - trailing_continuation_bytes(data))


def strip_continuation_bytes(data: Column) -> Column:
    """The value without continuation bytes at either end."""
    return rstrip_continuation_bytes(lstrip_continuation_bytes(data))


def is_valid_utf8(data: Column) -> Column:
    """True when the bytes are well-formed UTF-8."""
    return F.is_valid_utf8(data.cast("string"))
