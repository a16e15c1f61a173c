"""Words of a text: the runs of anything but ASCII white space, as columns and in Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """Array of words; empty for null, empty and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8: ``bytes.split`` and ``bytes.lower`` know ASCII alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()
