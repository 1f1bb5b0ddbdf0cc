"""Letters of Indic scripts in Latin letters, from their Unicode names."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf


@cache
def _letter(c: str) -> tuple[str, str]:
    """(kind, Latin letters) of a character; kinds: consonant, vowel, sign, stop, other."""
    if c.isascii():
        return "other", c
    name = unicodedata.name(c, "")
    kind, _, last = name.rpartition(" ")
    if "VIRAMA" in name or "SIGN VIRAMA" in name:
        return "stop", ""
    if "VOWEL SIGN" in kind:
        return "sign", last.lower()
    if "ANUSVARA" in name:
        return "sign", "n"
    if "VISARGA" in name:
        return "sign", "h"
    if "NUKTA" in name or unicodedata.category(c) in ("Mn", "Cf"):
        return "other", ""
    if unicodedata.category(c) == "Nd":
        return "other", str(unicodedata.digit(c))
    if "LETTER" in kind:
        last = last.lower()
        vowel = len(last.strip("aeiou")) == 0
        return ("vowel", last) if vowel else ("consonant", last)
    plain = unicodedata.normalize("NFKD", c)
    return "other", "".join(x for x in plain if x.isascii())


def transliterated(text: str) -> str:
    """Consonants carry their inherent ``a`` unless a vowel sign or a virama follows or the word ends."""
    if text.isascii():
        return text
    out = []
    kinds = [_letter(c) for c in text]
    for i, (kind, latin) in enumerate(kinds):
        if kind == "consonant" and latin.endswith("a"):
            following = kinds[i + 1] if i + 1 < len(kinds) else ("other", " ")
            ends = following[0] in ("other",) and following[1] != "" or i + 1 == len(kinds)
            vowel_sign = following[0] == "sign" and following[1] not in ("n", "h")
            latin = latin[:-1] if vowel_sign or following[0] == "stop" or ends else latin
        out.append(latin)
    return "".join(out)


def indic(text: Column) -> Column:
    @pandas_udf("string")
    def convert(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else transliterated(t))

    return convert(text)
