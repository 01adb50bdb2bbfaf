"""Regular expressions for the curation rules, in Java syntax.

All patterns are anchored at the start or stop at the first character that does
not fit, so that matching a long value takes time linear in its length.
"""

from __future__ import annotations

# ASCII letters and digits. As a named class Java tests it several times faster
# than as three ranges inside a negated class.
ALNUM = r"\p{Alnum}"

# Characters every text column may hold between its first and
# last letter or digit.
ALLOWED = "@;:,/\\._ -"

# The whitespace that regex \s stands for in Java.
WHITESPACE = " \t\n\x0b\f\r"

# Characters a date and a timestamp keep when they are repaired.
NOT_DATE = r"[^0-9/\-]"
NOT_TIMESTAMP = r"[^0-9+TZ:./ \-]"

# Digits with at most one point.
NUMBER = r"\A(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)\z"

# Numbers that no cleaning rule changes, and digits that a 64-bit integer holds.
PLAIN_NUMBER = r"\A[0-9]+(?:\.[0-9]+)?\z"
SHORT_INTEGER = r"\A0*[0-9]{1,10}\z"

# What counts as ISO text.
ISO_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_ISO_TIME = r"[0-9]{2}(?::[0-9]{2}){2}"
ISO_TIMESTAMP = ISO_DATE.removesuffix(r"\z") + rf"[T ]{_ISO_TIME}(?:\.[0-9]+)?(?:Z|[+-][0-9]{{2}}:[0-9]{{2}})?\z"

# The shapes of date text, with the fields as groups.
_YEAR = r"(-?[0-9]{4})"
_FIELD = r"0*([0-9]{1,2})"
YEAR_FIRST = rf"\A{_YEAR}([/-])([0-9]{{2}})\2([0-9]{{2}})\z"
YEAR_LAST_SLASH = rf"\A{_FIELD}/{_FIELD}/{_YEAR}\z"
YEAR_LAST_DASH = rf"\A{_FIELD}-{_FIELD}-{_YEAR}\z"

# A zone or offset after the time of day.
OWN_ZONE = r":[^Z+\-]*[Z+\-]"

# The detectors look through characters outside U+0007..z, wherever they stand.
_SKIP = r"[^\x07-z]*"


def _spaced(*tokens: str) -> str:
    return "".join(token + _SKIP for token in tokens)


_DIGIT = r"[0-9]"
_SEPARATOR = r"[/-]"
_ONE_OR_TWO = _spaced(_DIGIT) + "(?:" + _spaced(_DIGIT) + ")?"
_FOUR = _spaced(*[_DIGIT] * 4)
_BREAK = "(?:" + _spaced(r"\r") + ")?(?:" + _spaced(r"\n") + ")?"


def _date(*fields: str) -> str:
    return _spaced(_SEPARATOR).join(fields)


DATE_LIKE = (
    r"\A" + _SKIP + "(?:"
    + "|".join(
        (
            _date(_FOUR, _ONE_OR_TWO, _ONE_OR_TWO),
            _date(_ONE_OR_TWO, _ONE_OR_TWO, _FOUR),
            _date(_ONE_OR_TWO, _FOUR, _ONE_OR_TWO),
        )
    )
    + ")" + _BREAK + r"\z"
)

_TWO = [_DIGIT] * 2
TIMESTAMP_LIKE = _spaced(
    *[_DIGIT] * 4, _SEPARATOR, *_TWO, _SEPARATOR, *_TWO, "[T ]", *_TWO, ":", *_TWO, ":", _DIGIT
) + _DIGIT


def quoted(chars: str) -> str:
    """``chars`` as members of a character class."""
    return "".join("\\" + char for char in chars)


def not_allowed(chars: str) -> str:
    """Runs of characters that are neither letters, digits nor one of ``chars``."""
    return rf"[^{ALNUM}{quoted(chars)}]++"


def first_of_lead(chars: str) -> str:
    """Group 1: the first of ``chars`` in the leading run of non-alphanumerics."""
    keep = quoted(chars)
    return rf"\A[^{ALNUM}{keep}]*+([{keep}])"


def last_of_lead(chars: str) -> str:
    """Group 1: the last of ``chars`` in the leading run of non-alphanumerics."""
    return rf"\A[^{ALNUM}]*([{quoted(chars)}])"
