"""Transcript text: words, e-mail addresses, phone numbers and quality tests.

Two regex dialects meet here. Counting and extraction follow Unicode-aware rules (``(?U)``: word
boundaries, digits and blanks of any script). The quality tests follow SQL engines whose ``\\b`` and
``\\s`` are ASCII, so those boundaries are spelt out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipquarry.functions.columns import col, no_strings

# The blanks a Unicode-aware split knows, as a character class and one by one.
BLANK = r"\s\x1c-\x1f"
_BLANK_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
BLANK_CHARACTERS = "".join(chr(c) for low, high in _BLANK_RANGES for c in range(low, high + 1))
WORD = f"(?U)[^{BLANK}]+"
# The address and number patterns.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"\b(?:\+\d{1,2}\s?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b"
# How a paragraph with a phone number is labelled.
PHONE_TALK = r"\bphone\b"
OWN_NUMBER = r"\bmy\s+(phone\s+)?number\b"
PHONE_TALK_LABEL = "Phone-related context"
OWN_NUMBER_LABEL = "Request for own phone number"
# What the quality tests look for.
DOCUMENT_DUMP = "[Content_Types].xml"
MUSIC_NOTE = "♪"
ASCII_BLANKS = r"[\t\n\f\r ]"
ALL_CAPS = r"(?<![A-Za-z0-9_])[A-Z]{2,}(?![A-Za-z0-9_])"
ALL_CAPS_RUN = rf"((?<![A-Za-z0-9_])[A-Z]{{2,}}{ASCII_BLANKS}+){{2,}}"
SENTENCE_SHAPE = rf"([.!?]{ASCII_BLANKS}+[A-Z])|([.!?]\z)"
SINGLE_NAME = r"^[A-Z][a-z]+\n?\z"


def words(text: Column | str) -> Column:
    """Blank-separated words, none of them empty."""
    return F.regexp_extract_all(col(text), F.lit(WORD), F.lit(0))


def word_count(text: Column | str) -> Column:
    """Number of words; 0 for null."""
    counted = F.regexp_count(col(text), F.lit(WORD))
    return F.coalesce(counted, F.lit(0)).cast("long")


def strip_text(text: Column | str) -> Column:
    """Blanks of any script removed from both ends."""
    return F.btrim(col(text), F.lit(BLANK_CHARACTERS))


def extract_emails(text: Column | str) -> Column:
    """Every e-mail address. The cheap ``@`` test spares most transcripts the pattern."""
    found = F.regexp_extract_all(col(text), F.lit("(?U)" + EMAIL), F.lit(0))
    return F.when(F.contains(col(text), F.lit("@")), found).otherwise(no_strings())


def email_count(text: Column | str) -> Column:
    return F.size(extract_emails(text)).cast("long")


def extract_phones(text: Column | str) -> Column:
    """Every ten-digit number, with optional country code and brackets."""
    found = F.regexp_extract_all(col(text), F.lit("(?U)" + PHONE), F.lit(0))
    return F.coalesce(found, no_strings())


def phone_count(text: Column | str) -> Column:
    counted = F.regexp_count(col(text), F.lit("(?U)" + PHONE))
    return F.coalesce(counted, F.lit(0)).cast("long")


def normalize_us_phone(number: Column | str) -> Column:
    """``+1`` and the digits for ten-digit numbers, ``+`` and the digits otherwise. No number plan
    is consulted."""
    digits = F.regexp_replace(col(number), "[^0-9]", "")
    return F.when(F.length(digits) == 10, F.concat(F.lit("+1"), digits)).otherwise(
        F.concat(F.lit("+"), digits)
    )


def paragraphs(text: Column | str) -> Column:
    return F.split(col(text), "\n\n")


def phones_with_context(text: Column | str) -> Column:
    """``array<struct<number,context>>``: each number, normalised, with the label of its
    paragraph."""

    def labelled(paragraph: Column) -> Column:
        low = F.lower(paragraph)
        context = F.when(low.rlike("(?U)" + PHONE_TALK), PHONE_TALK_LABEL).when(
            low.rlike("(?U)" + OWN_NUMBER), OWN_NUMBER_LABEL
        )
        return F.transform(
            extract_phones(paragraph),
            lambda n: F.struct(normalize_us_phone(n).alias("number"), context.alias("context")),
        )

    return F.flatten(F.transform(paragraphs(text), labelled))


def noun_entities(entities: Column | str, labels: list[str]) -> Column:
    """Texts of the entities with one of ``labels`` that are one capitalised word."""
    kept = F.filter(
        col(entities),
        lambda e: e["label"].isin(labels)
        & (F.length(e["text"]) > 1)
        & e["text"].rlike(SINGLE_NAME),
    )
    return F.transform(kept, lambda e: e["text"])


def not_document_dump(text: Column | str) -> Column:
    return ~col(text).like(f"%{DOCUMENT_DUMP}%")


def no_all_caps(text: Column | str) -> Column:
    """No word of two or more capitals."""
    return ~col(text).rlike(ALL_CAPS)


def no_caps_run(text: Column | str) -> Column:
    """No two such words in a row."""
    return ~col(text).rlike(ALL_CAPS_RUN)


def has_sentence_shape(text: Column | str) -> Column:
    """A sentence end before a capital, or at the very end."""
    return col(text).rlike(SENTENCE_SHAPE)


def no_music(text: Column | str) -> Column:
    return ~F.contains(col(text), F.lit(MUSIC_NOTE))


def min_length(text: Column | str, n: int = 10) -> Column:
    return F.length(col(text)) >= n

