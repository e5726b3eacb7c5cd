"""MD5 that one task leaves off at a block and another one takes up.

What passes between tasks is the chaining value of RFC 1321: 16 bytes after any whole number of
blocks.  ``hashlib`` does not hand it out, OpenSSL's own ``MD5_CTX`` does.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
import math
import struct
import sys
from collections.abc import Callable
from functools import cache

#: Bytes of a block.
BLOCK = 64
#: The chaining value before the first block.
START = struct.pack("<4I", 0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)

# Fixed values of RFC 1321: what is added in a step, and how far it turns.
_ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = [t for turns in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in turns * 4]
_MASK = 0xFFFFFFFF

try:
    import _hashlib
except ModuleNotFoundError:
    # A Python built without OpenSSL.
    _hashlib = None

Chain = Callable[[bytes, bytes], bytes]


class _Context(ctypes.Structure):
    """``MD5_CTX`` of OpenSSL's md5.h; the count of bits and the rest of a block stay unused."""

    _fields_ = [
        ("value", ctypes.c_uint32 * 4),
        ("bits", ctypes.c_uint32 * 2),
        ("rest", ctypes.c_uint32 * 16),
        ("num", ctypes.c_uint),
    ]


def _of_library(name: str | None) -> Chain:
    update = ctypes.CDLL(name).MD5_Update
    update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]

    def chain(value: bytes, blocks: bytes) -> bytes:
        context = _Context(value=struct.unpack("<4I", value))
        update(ctypes.byref(context), blocks, len(blocks))
        return struct.pack("<4I", *context.value)

    return chain


def plain_blocks(value: bytes, blocks: bytes) -> bytes:
    """``md5_blocks`` step by step, for machines without the library: right, at 1 or 2 MB a second."""
    for words in struct.iter_unpack("<16I", blocks):
        a, b, c, d = before = struct.unpack("<4I", value)
        for i in range(64):
            if i < 16:
                mixed, at = d ^ (b & (c ^ d)), i
            elif i < 32:
                mixed, at = c ^ (d & (b ^ c)), 5 * i + 1
            elif i < 48:
                mixed, at = b ^ c ^ d, 3 * i + 5
            else:
                mixed, at = c ^ (b | (d ^ _MASK)), 7 * i
            total = (a + mixed + _ADDED[i] + words[at % 16]) & _MASK
            a, d, c, b = d, c, b, (b + (total << _TURNS[i] | total >> (32 - _TURNS[i]))) & _MASK
        value = struct.pack("<4I", *((x + y) & _MASK for x, y in zip(before, (a, b, c, d), strict=True)))
    return value


@cache
def _fastest() -> Chain:
    """OpenSSL where Python's hashes come from or the system has it, if it agrees with ``hashlib``."""
    sample = bytes(range(256)) * 5
    names = [getattr(_hashlib, "__file__", None)]
    if sys.platform == "linux":
        names.append(ctypes.util.find_library("crypto"))
    for name in names:
        try:
            chain = _of_library(name)
        except (AttributeError, OSError):
            continue
        if md5_end(START, sample, len(sample), chain) == hashlib.md5(sample, usedforsecurity=False).hexdigest():
            return chain
    return plain_blocks


def md5_blocks(value: bytes, blocks: bytes) -> bytes:
    """The chaining value after more bytes, a whole number of blocks."""
    if len(blocks) % BLOCK:
        raise ValueError(f"not a whole number of blocks of {BLOCK} bytes")
    return _fastest()(value, blocks)


def md5_end(value: bytes, rest: bytes, length: int, chain: Chain = md5_blocks) -> str:
    """The digest of ``length`` bytes in lowercase hex, from the value before the last ones, ``rest``."""
    zeros = bytes(-(len(rest) + 9) % BLOCK)
    return chain(value, rest + b"\x80" + zeros + struct.pack("<Q", length * 8 % 2**64)).hex()
