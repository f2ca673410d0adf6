"""Integers and texts out of BINARY columns, in built-in expressions only.

`hex_text` is a column holding the hex form of a byte range; byte `at` is 0-based in it.
"""

from pyspark.sql import Column, functions as F


def unsigned(hex_text: Column, at: int, size: int) -> Column:
    """Big-endian unsigned integer of at most 6 bytes, so it never reaches the sign bit."""
    return unsigned_at(hex_text, F.lit(at), size)


def unsigned_at(hex_text: Column, at: Column, size: int) -> Column:
    if not 1 <= size <= 6:
        raise ValueError(f"size must be 1 to 6 bytes: {size}")
    digits = F.substring(hex_text, at * 2 + 1, F.lit(size * 2))
    return F.conv(digits, 16, 10).cast("bigint")


def bits(word: Column, shift: int, width: int) -> Column:
    return F.shiftright(word, shift).bitwiseAND(F.lit((1 << width) - 1))


def bit_text(value: Column, width: int) -> Column:
    return F.lpad(F.bin(value), width, "0")


def mac_text(hex_text: Column, at: int) -> Column:
    """Six bytes as lower-case `aa:bb:cc:dd:ee:ff`."""
    parts = [F.substring(hex_text, at * 2 + 1 + 2 * i, 2) for i in range(6)]
    return F.lower(F.concat_ws(":", *parts))


def ipv4_text(hex_text: Column, at: int) -> Column:
    return F.concat_ws(".", *[unsigned(hex_text, at + i, 1).cast("string") for i in range(4)])
