"""One writing of a text's characters, whatever surface they were given."""

from __future__ import annotations

import re
import unicodedata

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(zip("аеорсухіјѕԁһӏνοαιρτυ", "aeopcyxijsdhlvoaiptu", strict=True))
_MARKS = {chr(c): "" for c in (*(c for c in range(0x250, 0x1B00) if unicodedata.category(chr(c)) == "Mn"), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
_OTHER = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Lower case without accents, invisible characters, compatibility forms and look-alike letters."""
    if text.isascii():
        return text.lower()
    return _swapped(_swapped(unicodedata.normalize("NFKD", text), _MARKS).lower(), _LOOKALIKES)


def _swapped(text: str, to: dict[str, str]) -> str:
    """As ``translate``, whose look-up of every character takes longer than a pass for each of the few that are there."""
    for c in to.keys() & set(text):
        text = text.replace(c, to[c])
    return text


def letters_and_digits(text: str) -> str:
    """The folded text's letters and digits, run together."""
    return _OTHER.sub("", fold(text))
