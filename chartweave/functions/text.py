"""Column functions over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The spellings that a delimited file may use for no value.
NULL_TOKENS = ["", "NA", "N/A", "n/a", "na", "null", "NULL", "None", "none", "nan", "NaN", "NAN"]


def ascii_tokens(text: Column) -> Column:
    """Lower-cased runs of a-z and 0-9, with repeats, for keyword search; an accented letter ends a run."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def word_set(text: Column) -> Column:
    """The distinct lower-cased runs of letters, digits and underscores of any script."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)))


# What full case folding changes beyond lower case, one character to one and one to several.
FOLD_ONE = {"ς": "σ", "ſ": "s", "µ": "μ", "ϐ": "β", "ϑ": "θ", "ϕ": "φ", "ϖ": "π", "ϰ": "κ", "ϱ": "ρ", "ϵ": "ε", "ẛ": "ṡ"}
FOLD_MORE = {"ß": "ss", "ŉ": "ʼn", "ǰ": "ǰ", "և": "եւ", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def casefolded(text: Column) -> Column:
    """Lower case with the foldings beyond it that texts hold."""
    out = F.lower(text)
    for a, b in (FOLD_ONE | FOLD_MORE).items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def normalised(text: Column) -> Column:
    """White space runs as one blank, trimmed, case folded: what makes two texts the same text."""
    return casefolded(F.trim(F.regexp_replace(text, r"\s+", " ")))


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(~text.rlike(r"\S"), F.lit(True))


def metadata_text(value: Column) -> Column:
    """Null and the empty text are no value; everything else is its text."""
    return F.nullif(value.cast("string"), F.lit(""))


def estimated_tokens(text: Column) -> Column:
    """A quarter of the characters, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4).cast("int"))


def text_hash(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def finite_number(text: Column) -> Column:
    """The number a text holds, null where it holds none or one that isn't finite."""
    n = F.trim(text).try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n)


def non_overlapping_count(text: Column, needle: str, ignore_case: bool = True) -> Column:
    """How often a literal occurs without overlaps."""
    t, n = (F.lower(text), needle.lower()) if ignore_case else (text, needle)
    return ((F.length(t) - F.length(F.replace(t, F.lit(n), F.lit("")))) / len(n)).cast("int")
