"""Text gates, tokens and rewrites as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from dialoom.config import MAX_UTTERANCE_CHARS

# Character classes and patterns.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SUPPORTED = r"\x20-\x7E‘’“”—–…À-ÖØ-öø-ÿ"
ASCII_SUPPORTED = r"\x20-\x7E‘’“”—–…"
URL = r"(?i)(https?://|www\.)\S+"
#: Bold, emphasis with no word character on either side, code, heading, bullet, link.
MARKDOWN = (r"\*\*[^*]+\*\*", r"(?<![\p{L}\p{N}_])_[^_]+_(?![\p{L}\p{N}_])", r"`[^`]+`", r"^\s*#{1,6}\s", r"^\s*[-*]\s", r"\[[^\]]+\]\([^)]+\)")
BLANK = r"^[\s\p{Z}\x1c-\x1f\x85]*$"
#: Letters of Latin-1 that come apart into a small ASCII letter and a mark, and that letter; the others have none.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def has_control(text: Column) -> Column:
    """Any character of category C, line breaks and tabs included."""
    return text.rlike(r"\p{C}")


def has_unsupported(text: Column) -> Column:
    return text.rlike(f"[^{SUPPORTED}]")


def has_url(text: Column) -> Column:
    return text.rlike(URL)


def has_markdown(text: Column) -> Column:
    return text.rlike("|".join(f"(?:{p})" for p in MARKDOWN))


def too_long(text: Column, most: int = MAX_UTTERANCE_CHARS) -> Column:
    return F.length(text) > most


def is_blank(text: Column) -> Column:
    return text.rlike(BLANK)


def tokens(text: Column) -> Column:
    """Runs of letters and apostrophes with at least one letter, as they stand."""
    return F.filter(F.regexp_extract_all(text, F.lit(f"[{LETTERS}']+"), F.lit(0)), lambda w: F.btrim(w, F.lit("'")) != "")


def spoken(word: Column) -> Column:
    """A word as an aligner takes it: small ASCII letters and apostrophes; letters that don't come apart go."""
    return F.regexp_replace(F.translate(F.lower(word), ACCENTED, PLAIN), "[^a-z']", "")


def pronounce(text: Column, mapping: dict[str, str]) -> Column:
    """Mark whole words, whatever their case, as ``[word](/ipa/)``; longer words first."""
    for word in sorted(mapping, key=len, reverse=True):
        ipa = mapping[word].replace("\\", "\\\\").replace("$", "\\$")
        text = F.regexp_replace(text, rf"(?iuU)\b({re.escape(word)})\b", f"[$1](/{ipa}/)")
    return text


def offending(text: Column) -> Column:
    """The characters that diagnostics list: outside ASCII and the typographic marks."""
    return F.filter(F.split(text, ""), lambda c: c.rlike(f"[^{ASCII_SUPPORTED}]"))


def code_point(char: Column) -> Column:
    return F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(char)), 4, "0"))


def format_hms(seconds: Column) -> Column:
    s = F.greatest(F.floor(seconds), F.lit(0)).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
