"""What SQL functions lack: stemming, Unicode normal forms, close matches. Arrow UDFs; use them on distinct values."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

_VOWEL = re.compile("[aeiou]")


def _cons(w: str, i: int) -> bool:
    c = w[i]
    return c not in "aeiou" and (c != "y" or i == 0 or not _cons(w, i - 1))


def _measure(stem: str) -> int:
    shape = "".join("c" if _cons(stem, i) else "v" for i in range(len(stem)))
    return len(re.findall("v+c+", shape))


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _cvc(w: str) -> bool:
    return len(w) > 2 and _cons(w, len(w) - 1) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 3) and w[-1] not in "wxy"


# The published suffix tables of the algorithm.
_STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log"}
_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
# End of fixed values.


def porter(word: str) -> str:
    """Porter's stem of a lower-case ASCII word; other words and words of one or two letters stay."""
    w = word
    if len(w) < 3 or not w.isascii() or not w.isalpha():
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    again = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, again = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, again = w[:-3], True
    if again:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif len(w) > 1 and w[-1] == w[-2] and _cons(w, len(w) - 1) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    for table in (_STEP2, _STEP3):
        for suffix in sorted(table, key=len, reverse=True):
            if w.endswith(suffix):
                if _measure(w[: -len(suffix)]) > 0:
                    w = w[: -len(suffix)] + table[suffix]
                break
    for suffix in sorted(_STEP4, key=len, reverse=True):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


def fold(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def stem_term(term: pd.Series) -> pd.Series:
    """Diacritics folded, then stemmed."""
    return term.map(lambda w: None if w is None else porter(fold(w)))


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def nfkd_letters(text: pd.Series) -> pd.Series:
    """Letters and digits only, decomposed and without marks, lower case, doubled characters single."""

    def own(t: str | None) -> str | None:
        if t is None:
            return None
        kept = "".join(c for c in unicodedata.normalize("NFKD", t).lower() if c.isalnum())
        return re.sub(r"(.)\1+", r"\1", kept)

    return text.map(own)


def close_ratio(cutoff: float):
    """UDF (word, candidate) -> the matching-blocks ratio where it reaches the cutoff, else null; the bounds tried first are exact."""

    @F.pandas_udf(DoubleType())
    def run(word: pd.Series, candidate: pd.Series) -> pd.Series:
        match, out = difflib.SequenceMatcher(), []
        last = None
        for w, c in zip(word, candidate, strict=True):
            if w is None or c is None:
                out.append(None)
                continue
            if w != last:
                match.set_seq2(w)
                last = w
            match.set_seq1(c)
            ratio = match.ratio() if match.real_quick_ratio() >= cutoff and match.quick_ratio() >= cutoff else 0.0
            out.append(ratio if ratio >= cutoff else None)
        return pd.Series(out, dtype="float64")

    return run
