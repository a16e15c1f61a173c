"""CSV dialects as Column expressions.

A record is split into cells inside the JVM. Text without a quote or escape
character takes the plain ``split`` branch, and text whose cells are all simply quoted a ``split``
between the quotes; only the rest pays for the pattern.
The rules are those of Python's ``csv.reader`` in its default, lenient mode:
a quote opens a field only at the field's start, a doubled quote stands for one,
text after a closing quote is appended, and an unclosed quote runs to the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

#: Names that Python gives to encodings, and what they are decoded as. Others go to Spark's ``decode`` as they are.
UTF8 = ("utf-8", "utf8", "utf-8-sig")
LATIN = ("latin-1", "latin1", "iso-8859-1", "iso8859-1", "l1")
WINDOWS = ("cp1252", "windows-1252", "1252")


def _windows_letters() -> tuple[str, str]:
    """The control characters of Latin-1 that stand for letters and signs in Windows-1252, and these."""
    pairs = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
    return "".join(a for a, b in pairs if b), "".join(b for _, b in pairs)


def _escaped(ch: str) -> str:
    """``ch`` as a literal that is safe inside and outside a character class."""
    return ch if ch.isalnum() else "\\" + ch


@dataclass(frozen=True)
class CsvDialect:
    delimiter: str = ","
    quotechar: str | None = '"'
    doublequote: bool = True
    escapechar: str | None = None
    skipinitialspace: bool = False
    encoding: str = "utf-8"

    def __post_init__(self):
        for name in ("delimiter", "quotechar", "escapechar"):
            value = getattr(self, name)
            if value is not None and len(value) != 1:
                raise ValueError(f"{name} must be a single character, got {value!r}")

    @property
    def is_utf8(self) -> bool:
        return self.encoding.lower().replace("_", "-") in UTF8

    # -- pattern pieces: possessive, so Java matches them without recursion ----

    def _run(self, *stops: str | None, pairs: tuple[str, ...] = ()) -> str:
        klass = "[^" + "".join(_escaped(s) for s in stops if s) + "]*+"
        extra = list(pairs)
        if self.escapechar:
            extra.append(_escaped(self.escapechar) + ".")
        return klass + (f"(?:(?:{'|'.join(extra)}){klass})*+" if extra else "")

    @property
    def _body(self) -> str:
        q = _escaped(self.quotechar)
        return self._run(self.quotechar, self.escapechar, pairs=(q + q,) if self.doublequote else ())

    @property
    def _bare(self) -> str:
        return self._run(self.delimiter, self.escapechar)

    @property
    def _gap(self) -> str:
        return " *+" if self.skipinitialspace else ""

    @property
    def _field(self) -> str:
        if self.quotechar is None:
            return self._bare
        q, tail = _escaped(self.quotechar), self._bare
        if self.escapechar and self.doublequote:
            # the character that follows the closing quote is never an escape
            tail = f"(?:[^{_escaped(self.delimiter)}]{tail})?+"
        return f"(?:{q}{self._body}{q}{tail}|(?!{q}){self._bare})"

    # -- expressions ----------------------------------------------------------

    def decoded(self, value: Column) -> Column:
        """A line's text. The line's end is cut here where the scan leaves half of it (UTF-16)."""
        if self.is_utf8:
            return value
        name = self.encoding.lower().replace("_", "-")
        if name in LATIN or name in WINDOWS:
            text = F.decode(value.cast("binary"), "ISO-8859-1")
            return F.translate(text, *_windows_letters()) if name in WINDOWS else text
        text = F.decode(value.cast("binary"), self.encoding)
        if name.startswith("utf-16"):
            text = F.regexp_replace(text, "\\A\ufeff|\r\\z", "")
        return text

    def is_broken(self, value: Column) -> Column:
        """Whether a line as read is not valid in the encoding; single-byte encodings always are."""
        return ~F.is_valid_utf8(value) if self.is_utf8 else F.lit(False)

    def is_plain(self, record: Column) -> Column:
        """No quote, escape or skipped blank: the record is a plain ``split``."""
        plain = F.lit(True)
        for ch in (self.quotechar, self.escapechar):
            if ch:
                plain = plain & ~F.contains(record, F.lit(ch))
        if self.skipinitialspace:
            plain = plain & ~F.contains(record, F.lit(self.delimiter + " ")) & ~F.startswith(record, F.lit(" "))
        return plain

    def is_all_quoted(self, record: Column) -> Column:
        """Every cell is quoted and holds no quote: a ``split`` between the quotes."""
        d, q = _escaped(self.delimiter), _escaped(self.quotechar)
        cell = f"{q}[^{q}{_escaped(self.escapechar) if self.escapechar else ''}]*+{q}"
        pattern = rf"(?s)\A{cell}(?:{d}{cell})*+\z"
        return F.startswith(record, F.lit(self.quotechar)) & F.rlike(record, F.lit(pattern))

    def leaves_open(self, line: Column) -> Column:
        """Does a line that starts outside a quoted field end inside one?"""
        if self.quotechar is None:
            return F.lit(False)
        d, q = _escaped(self.delimiter), _escaped(self.quotechar)
        pattern = rf"(?s)\A(?:{self._gap}{self._field}{d})*+{self._gap}{q}{self._body}\z"
        return F.contains(line, F.lit(self.quotechar)) & ~self.is_all_quoted(line) & F.rlike(line, F.lit(pattern))

    def stays_open(self, line: Column) -> Column:
        """Does a line that starts inside a quoted field end inside one?"""
        if self.quotechar is None:
            return F.lit(False)
        return ~F.contains(line, F.lit(self.quotechar)) | self.leaves_open(F.concat(F.lit(self.quotechar), line))

    def cells(self, record: Column) -> Column:
        """The record's cells, ``''`` for an empty one; a blank record has none."""
        d = _escaped(self.delimiter)
        plain = F.split(record, d, -1)
        if self.quotechar is None and self.escapechar is None and not self.skipinitialspace:
            tokens = plain
        else:
            tokens = F.when(self.is_plain(record), plain)
            if self.quotechar is not None:
                between = F.substring(record, F.lit(2), F.length(record) - 2)
                q = _escaped(self.quotechar)
                tokens = tokens.when(self.is_all_quoted(record), F.split(between, q + d + q, -1))
            tokens = tokens.otherwise(self._tokens(record))
        return F.when(record == "", F.array().cast("array<string>")).otherwise(tokens)

    def _tokens(self, record: Column) -> Column:
        d = _escaped(self.delimiter)
        # a leading delimiter makes every match non-empty, so none is skipped
        text = F.concat(F.lit(self.delimiter), record)
        open_field = ""
        if self.quotechar is not None:
            open_field = f"|{_escaped(self.quotechar)}{self._body}"
        pattern = f"(?s){d}{self._gap}({self._field}{open_field})"
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), self._unquoted)

    def _unquoted(self, token: Column) -> Column:
        plain = token
        if self.escapechar:
            plain = F.regexp_replace(token, f"(?s){_escaped(self.escapechar)}(.)", "$1")
        if self.quotechar is None:
            return plain
        q = _escaped(self.quotechar)
        shape = f"(?s)\\A{q}({self._body}){q}?(.*)\\z"
        body = F.regexp_extract(token, shape, 1)
        tail = F.regexp_extract(token, shape, 2)
        if self.escapechar:
            # one pass, so that an escaped quote is not taken for a doubled one
            pair = f"(?s)(?:{_escaped(self.escapechar)}(.)" + (f"|{q}({q}))" if self.doublequote else "|(\\z\\A))")
            body = F.regexp_replace(body, pair, "$1$2")
            first = 1 if self.doublequote else 0
            tail = F.concat(
                F.substring(tail, 1, first),
                F.regexp_replace(F.substring(tail, first + 1, 2**31 - 1), f"(?s){_escaped(self.escapechar)}(.)", "$1"),
            )
        elif self.doublequote:
            body = F.replace(body, F.lit(self.quotechar * 2), F.lit(self.quotechar))
        quoted = F.startswith(token, F.lit(self.quotechar))
        simple = quoted & (F.locate(self.quotechar, token, 2) == F.length(token))
        if self.escapechar:
            simple = simple & ~F.contains(token, F.lit(self.escapechar))
        # most quoted cells are simple and need no pattern
        inner = F.substring(token, F.lit(2), F.length(token) - 2)
        return F.when(simple, inner).when(quoted, F.concat(body, tail)).otherwise(plain)
