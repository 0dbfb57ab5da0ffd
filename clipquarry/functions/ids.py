"""Reversible pseudonyms for identifiers, and hash buckets.

A pseudonym is base32 text over a permuted alphabet of five salt bytes and the identifier, each byte
XORed with one constant. It hides names from a casual reader; it is obfuscation, not encryption.
All of it is built from ``hex``, ``conv`` and ``translate``: five bytes are ten hex digits are eight
base-32 digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipquarry.functions.columns import col, let

# The permuted base32 alphabet, and what XOR 0x55 does to a hex digit.
ALPHABET = "ZXYWVUTSRQPONMLKJIHGFEDCBA576432"
HEX_DIGITS = "0123456789ABCDEF"
HEX_DIGITS_XORED = "54761032DCFE98BA"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
SALT_BYTES = 5


def _rebase(digits: Column, width_in: int, base_in: int, width_out: int, base_out: int) -> Column:
    """Rewrites blocks of ``width_in`` digits as blocks of ``width_out`` in the other base; the last
    block is filled up with zeros."""

    def block(piece: Column) -> Column:
        filled = F.rpad(piece, width_in, F.lit("0"))
        return F.lpad(F.conv(filled, base_in, base_out), width_out, "0")

    blocks = F.regexp_extract_all(digits, F.lit(f".{{1,{width_in}}}"), F.lit(0))
    return F.array_join(F.transform(blocks, block), "")


def encode_id(
    identifier: Column | str, key: str = "", salted_by: Column | str | None = None
) -> Column:
    """Pseudonym of an identifier. The salt comes from a keyed hash of ``salted_by`` (the identifier
    itself by default), so a rerun gives the same name; use a private ``key`` per dataset, and salt by
    what tells equal identifiers apart."""
    plain = col(identifier)
    source = plain if salted_by is None else col(salted_by)
    salt = F.left(F.sha2(F.concat(source, F.lit(key)), 256), F.lit(2 * SALT_BYTES))
    digits = F.concat(F.upper(salt), F.hex(F.encode(plain, "UTF-8")))

    def symbols(mixed: Column) -> Column:
        kept = F.ceil(F.length(mixed) * 4 / 5).cast("int")
        return F.translate(F.left(_rebase(mixed, 10, 16, 8, 32), kept), BASE32_DIGITS, ALPHABET)

    return let(F.translate(digits, HEX_DIGITS, HEX_DIGITS_XORED), symbols)


def decode_id(pseudonym: Column | str) -> Column:
    """The identifier behind a pseudonym."""

    def plain(symbols: Column) -> Column:
        kept = F.floor(F.length(symbols) * 5 / 8).cast("int") * 2
        mixed = F.left(_rebase(symbols, 8, 32, 10, 16), kept)
        digits = F.translate(mixed, HEX_DIGITS_XORED, HEX_DIGITS)
        return F.decode(F.unhex(F.substring(digits, F.lit(2 * SALT_BYTES + 1), kept)), "UTF-8")

    return let(F.translate(col(pseudonym), ALPHABET, BASE32_DIGITS), plain)


def hash_bucket(value: Column | str, n: int = 20) -> Column:
    """Bucket 0 to n-1."""
    return F.pmod(F.xxhash64(col(value)), F.lit(n)).cast("int")
