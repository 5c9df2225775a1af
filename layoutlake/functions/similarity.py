"""Similarities that no built-in function gives, as Arrow-batched functions."""

from __future__ import annotations

import functools
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(DoubleType())
def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio, 0 if either is empty; the order of arguments matters."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in zip(left, right, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def plain_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """``ratio`` with frequent characters counted too."""
    return pd.Series([SequenceMatcher(None, a, b, autojunk=False).ratio() if a and b else 0.0 for a, b in zip(left, right, strict=True)], dtype=float)


@F.pandas_udf(StringType())
def fold(text: pd.Series) -> pd.Series:
    """Case-folded and decomposed, combining marks removed."""
    return text.map(lambda s: None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s.casefold()) if not unicodedata.combining(c)))


@F.pandas_udf(StringType())
def _normalized(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


# Ligatures.
LIGATURES = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl"}


@functools.lru_cache(maxsize=1)
def unstable() -> str:
    """Pattern of one character that may be other in composed form or join the one before it; none is below U+0300."""
    found = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for c in (chr(k) for k in range(0x300, 0x110000) if not 0xD800 <= k < 0xE000):
        if unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c:
            found.add(ord(c))
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(int(parts[1], 16))
    spans: list[list[int]] = []
    for k in sorted(found):
        if spans and k == spans[-1][1] + 1:
            spans[-1][1] = k
        else:
            spans.append([k, k])
    return r"(?=[^\x{0}-\x{2ff}])[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans) + "]"


def compose(c: Column) -> Column:
    """Composed characters, ligatures and no-break spaces resolved, byte-order marks dropped.

    Only texts that composition may change go to Python, one by one in the places of the others' nulls.
    """
    out = F.translate(c, "\u00a0\ufeff", " ")
    for ligature, letters in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return F.coalesce(_normalized(F.when(out.rlike(unstable()), out)), out)
