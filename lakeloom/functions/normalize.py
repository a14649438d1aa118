"""Normalization of names, addresses and countries as column expressions.

Blank ('') is the null of this model: every function gives '' for null. Only
the Unicode fold runs in Python (Spark has no NFKD); the rest stays in the JVM.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# fixed values
LEGAL_SUFFIXES = ["inc", "incorporated", "corp", "corporation", "llc", "l l c", "plc", "ltd", "limited", "co", "company", "lp", "llp", "gmbh", "sa", "nv"]
ADDRESS_WORDS = {"street": "st", "avenue": "ave", "boulevard": "blvd", "road": "rd", "drive": "dr", "lane": "ln", "court": "ct", "suite": "ste", "apartment": "apt", "room": "rm", "building": "bldg", "floor": "fl", "north": "n", "south": "s", "east": "e", "west": "w"}
COUNTRIES = {
    "us": ["united states", "united states of america", "usa", "u s a", "us"],
    "gb": ["united kingdom", "uk", "u k", "great britain"],
    "ca": ["canada"],
    "de": ["germany", "deutschland"],
    "fr": ["france"],
    "au": ["australia"],
    "in": ["india"],
    "cn": ["china"],
    "jp": ["japan"],
    "br": ["brazil"],
    "mx": ["mexico"],
}
ALIASES = ["dba", "doing business as"]

#: A trailing run of suffix words; 'l l c' can never match a single word and is left out.
_WORDS = "|".join(w for w in LEGAL_SUFFIXES if " " not in w)
WORD = re.compile("[A-Za-z0-9_]+")
SUFFIX_RUN = f"(^| )({_WORDS})( ({_WORDS}))*$"


def fold_array(text: pa.Array) -> pa.Array:
    """The fold of a whole Arrow array: bytes outside ASCII are dropped from the decomposed text in one step."""
    out = pc.utf8_normalize(pc.utf8_lower(pc.fill_null(text, "")), "NFKD").cast(pa.large_string())
    if not len(out):
        return out.cast(pa.string())
    offs = np.frombuffer(out.buffers()[1], np.int64, len(out) + 1, out.offset * 8)
    data = np.frombuffer(out.buffers()[2], np.uint8)[offs[0] : offs[-1]] if offs[-1] > offs[0] else np.zeros(0, np.uint8)
    plain = data < 128
    at = np.concatenate([[0], np.cumsum(plain)])[offs - offs[0]].astype(np.int32)
    return pa.StringArray.from_buffers(len(out), pa.py_buffer(at), pa.py_buffer(data[plain]))


@F.arrow_udf(StringType())
def _fold(text: pa.Array) -> pa.Array:
    return fold_array(text)


#: Characters of either end of a text, and words wanted of each.
END, N_WORDS = 256, 6


def ends_array(text: pa.Array) -> pa.Array:
    """The first and the last six words of each cleaned text, the two joined by a line break.

    Cleaning takes each character by itself, so the words of an end are those of the whole, but for one that the cut may have split:
    an end that holds more than six words will do, or a text no longer than an end. Only other texts are cleaned whole.
    """
    text = pc.fill_null(text, "")
    short = pc.less_equal(pc.utf8_length(text), END).to_pylist()
    heads, tails = (fold_array(pc.utf8_slice_codeunits(text, *at)).to_pylist() for at in ((0, END), (-END,)))
    out = []
    for i, (is_short, head, tail) in enumerate(zip(short, heads, tails, strict=True)):
        a, z = WORD.findall(head), WORD.findall(tail)
        if not is_short and min(len(a), len(z)) <= N_WORDS:
            a = z = WORD.findall(fold_array(text.slice(i, 1))[0].as_py())
        out.append(f"{' '.join(a[:N_WORDS])}\n{' '.join(z[-N_WORDS:])}")
    return pa.array(out, pa.string())


@F.arrow_udf(StringType())
def six_words(text: pa.Array) -> pa.Array:
    return ends_array(text)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(text: Column | str) -> Column:
    """Lower case, compatibility decomposition, ASCII only. Lowering comes first: decomposed capitals stay. Only texts with other characters go to Python."""
    given = F.coalesce(_col(text).cast("string"), F.lit(""))
    plain = F.octet_length(given) == F.length(given)
    return F.when(plain, F.lower(given)).otherwise(_fold(F.when(~plain, given)))


def clean_text(text: Column | str) -> Column:
    """The fold, with every run of other characters than letters, digits and underscore as one space, trimmed."""
    return F.trim(F.regexp_replace(fold(text), "[^A-Za-z0-9_]+", " "))


def after_alias(cleaned: Column) -> Column:
    """What follows the last ' dba ', else the last ' doing business as '."""
    out = cleaned
    for alias in reversed(ALIASES):
        mark = f" {alias} "
        out = F.when(cleaned.contains(mark), F.element_at(F.split(cleaned, mark), -1)).otherwise(out)
    return out


def clean_name(cleaned: Column) -> Column:
    """A name from cleaned text: after its alias, without trailing legal suffixes (which may leave nothing)."""
    return F.regexp_replace(F.trim(after_alias(cleaned)), SUFFIX_RUN, "")


def clean_address(cleaned: Column) -> Column:
    words = F.create_map(*[F.lit(x) for pair in ADDRESS_WORDS.items() for x in pair])
    return F.array_join(F.transform(F.split(cleaned, " "), lambda w: F.coalesce(F.element_at(words, w), w)), " ")


def clean_country(cleaned: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for code, names in COUNTRIES.items() for name in names for x in (name, code)])
    return F.coalesce(F.element_at(codes, cleaned), cleaned)


def normalize_name(text: Column | str) -> Column:
    return clean_name(clean_text(text))


def normalize_address(text: Column | str) -> Column:
    return clean_address(clean_text(text))


def normalize_country(text: Column | str) -> Column:
    return clean_country(clean_text(text))


def tokens(text: Column | str) -> Column:
    """The distinct words between spaces; none for blank or null."""
    return F.array_distinct(F.filter(F.split(F.coalesce(_col(text), F.lit("")), " "), lambda w: w != ""))


def char_ngrams(text: Column | str, n: int = 3) -> Column:
    """The distinct substrings of n characters of the text without spaces; none if it is shorter."""
    bare = F.regexp_replace(F.coalesce(_col(text), F.lit("")), " ", "")
    places = F.when(F.length(bare) >= n, F.sequence(F.lit(1), F.length(bare) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(bare, i, F.lit(n))))
