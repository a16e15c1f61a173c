"""Expressions and plain functions on header names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# A class applies when ``seen`` occurs in the lower-cased name and
# ``unless`` does not; its replacements are then made in order, case-sensitively.
# Only the first class that applies is used.
TYPO_CLASSES = (
    # seen, unless, replacements
    ("recieved", None, (("recieved", "received"), ("reciev", "received"))),
    ("proccessed", None, (("proccessed", "processed"), ("proccess", "process"))),
    ("sampl", "sample", (("sampl", "sample"),)),
    ("barcod", "barcode", (("barcod", "barcode"),)),
)

# Characters a database dislikes in a name and what replaces them.
NAME_CHARACTERS = (("#", ""), ("%", "_pct"), ("-", "_"))

# Words that vendors' exports are known to misspell.
KNOWN_TYPOS = {
    "received": "recieved",
    "processed": "proccessed",
    "sample": "sampl",
    "barcode": "barcod",
    "laboratory": "laborator",
    "total": "totl",
    "organic": "orgainc",
    "carbon": "carban",
    "matter": "mattr",
}

# File-name prefixes and the vendor each one stands for.
VENDOR_PREFIXES = {"vendor_a": "vendor_a", "vendor_b": "vendor_b"}


def _replaced(name: Column, pairs) -> Column:
    for old, new in pairs:
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def repair_typos(name: Column) -> Column:
    lower = F.lower(name)
    out = None
    for seen, unless, pairs in TYPO_CLASSES:
        test = F.contains(lower, F.lit(seen))
        if unless:
            test = test & ~F.contains(lower, F.lit(unless))
        out = F.when(test, _replaced(name, pairs)) if out is None else out.when(test, _replaced(name, pairs))
    return out.otherwise(name)


def sanitize(name: Column) -> Column:
    return _replaced(name, NAME_CHARACTERS)


def renamed(name: Column, renames: Mapping[str, str]) -> Column:
    """``name`` through a small fixed dictionary."""
    out = name
    for old, new in renames.items():
        out = F.when(name == old, F.lit(new)).otherwise(out)
    return out


def vendor_of(file_name: Column, prefixes: Mapping[str, str] = VENDOR_PREFIXES) -> Column:
    out = None
    for prefix, vendor in prefixes.items():
        test = F.startswith(file_name, F.lit(prefix))
        out = F.when(test, F.lit(vendor)) if out is None else out.when(test, F.lit(vendor))
    return out.otherwise(F.lit("unknown")) if out is not None else F.lit("unknown")


def logical_file_name(file_path: Column) -> Column:
    """The ``*.csv`` segment of a path: the file itself, or its folder of part files."""
    plain = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    # a folder of part files may be a partition (name=value); a file keeps its whole name
    folder = F.regexp_extract(plain, r"/(?:[^/=]+=)?([^/]+\.csv)/[^/]+$", 1)
    return F.when(folder != "", folder).otherwise(F.element_at(F.split(plain, "/"), -1))


def defects(name: Column, known: Mapping[str, str] = KNOWN_TYPOS) -> dict[str, Column]:
    """Flags for what is wrong with a header name."""
    lower = F.lower(name)
    # a misspelling that is a prefix of the right word counts only without it
    typo = F.lit(False)
    for right, wrong in known.items():
        test = F.contains(lower, F.lit(wrong))
        if wrong in right:
            test = test & ~F.contains(lower, F.lit(right))
        typo = typo | test
    return {
        "has_typo": typo,
        "has_casing": name != lower,
        "has_outer_whitespace": name != F.trim(name),
        "has_inner_whitespace": F.contains(F.trim(name), F.lit(" ")),
        "has_bad_character": F.rlike(name, F.lit("[#%-]")),
    }


def id_pattern(prefix: str, total_length: int, separator_at: int | None = None, separator: str = "-") -> str:
    """Regular expression for an identifier: prefix, digits, separator at a position."""
    digits = total_length - len(prefix) - (len(separator) if separator_at is not None else 0)
    if digits <= 0:
        raise ValueError(f"length {total_length} leaves no digits after {prefix!r}")
    # anything else is put into a character class of its own
    safe = lambda s: "".join(c if c.isalnum() or c in "_ -" else f"[{c}]" for c in s)
    if separator_at is None:
        return f"^{safe(prefix)}[0-9]{{{digits}}}$"
    before = separator_at - len(prefix)
    if not 0 <= before <= digits:
        return f"^{safe(prefix)}[0-9]{{{digits}}}$"
    return f"^{safe(prefix)}[0-9]{{{before}}}{safe(separator)}[0-9]{{{digits - before}}}$"


def require_columns(columns: Sequence[str], wanted: Sequence[str]) -> None:
    missing = [c for c in wanted if c not in columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
