"""Page names: Unicode NFC, underscores and white space made single spaces, case kept."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters that NFC never changes and that never join with a neighbour from the same set:
#: everything below the combining marks, kana, unified ideographs and whole Hangul syllables.
STABLE = r"^[\x{0}-\x{2FF}\x{2010}-\x{2027}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}]*$"
SPACE = r"(?U)[\s_\x{1C}-\x{1F}]+"


def page_name(title: str | None) -> str | None:
    """The Python form of name()."""
    if title is None:
        return None
    return " ".join(unicodedata.normalize("NFC", title).replace("_", " ").split())


@F.arrow_udf(StringType())
def _nfc(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else unicodedata.normalize("NFC", v) for v in values.to_pylist()], pa.string())


def nfc(col: Column) -> Column:
    """Unicode NFC; only values that may change travel to Python, the rest as nulls."""
    return F.when(col.rlike(STABLE), col).otherwise(_nfc(F.when(~col.rlike(STABLE), col)))


def name(col: Column) -> Column:
    """Canonical page name of a stored title; null stays null, a blank title gives ''."""
    return F.trim(F.regexp_replace(nfc(col), SPACE, " "))


def filled(col: Column) -> Column:
    """True for a value that is neither null nor only white space."""
    return F.coalesce(col.rlike(r"(?U)[^\s\x{1C}-\x{1F}]"), F.lit(False))
