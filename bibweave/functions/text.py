"""Text fields as match keys.

``title_key`` and ``abstract_key`` keep the letters of a text and those numerals that
are not ASCII digits, lower-cased and run together; ``names_key`` keeps the last
word of each name.  All steps are JVM expressions except one: Spark has no Unicode
normalisation, so texts with a character beyond ASCII (the others are passed as
null) take one Arrow batch function.

Defined cases: null gives null, and so does a text of which nothing is left.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bibweave.scratch import small_batches

_SPACE = r"(?U)[\s\x1c-\x1f]"
#: White space at the end, found in linear time: only the start of a run is tried.
_TAIL = r"(?U)(?<![\s\x1c-\x1f])[\s\x1c-\x1f]++\z"
#: What is cut from an abstract from a copyright notice to the end of its line.
_COPYRIGHT = (r"(?Ud)copyright[\s\x1c-\x1f]+\d{4}.*", r"(?Ud)(?:copyright|(?<![\s\x1c-\x1f]))[\s\x1c-\x1f]++\(c\)[\s\x1c-\x1f]++\d{4}.*")


def _marks() -> re.Pattern:
    """One or more combining marks (category Mn)."""
    own = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Mn"]
    return re.compile(f"[{''.join(own)}]+")


_MARKS: list[re.Pattern] = []


def _bare(text: str) -> str:
    if not _MARKS:
        _MARKS.append(_marks())
    plain = _MARKS[0].sub("", unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text)))
    return plain if plain.isascii() else unicodedata.normalize("NFC", plain)


_WIDE = re.compile(r"[^\x00-\x7F]+")
#: Runs of up to so many characters are looked up once, and so many of them are kept.
SHORT_RUN, MOST_RUNS = 8, 100_000


def _bare_all(texts: pa.Array) -> pa.Array:
    """The same for a batch, run by run of characters beyond ASCII.

    No ASCII character decomposes, and of what is left after the marks are gone none composes with one,
    so what stands between runs stays, and runs do not depend on it. Most runs are an accented letter that was met before.
    """
    known: dict[str, str] = {}

    def bare(found: re.Match) -> str:
        run = found[0]
        if (plain := known.get(run)) is None:
            plain = _bare(run)
            if len(run) <= SHORT_RUN:
                if len(known) >= MOST_RUNS:
                    known.clear()
                known[run] = plain
        return plain

    return pa.array([None if t is None else _WIDE.sub(bare, t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _unaccented(texts: pa.Array) -> pa.Array:
    return _bare_all(texts)


def unaccent(text: Column) -> Column:
    """Compatibility form without combining marks."""
    return F.coalesce(_unaccented(F.when(text.rlike("[^\\x00-\\x7F]"), text)), text)


def strip_tags(text: Column) -> Column:
    """Removes ``<...>`` with something between; read in linear time, as only the part up to the last ``>`` is searched."""
    tail = F.substring_index(text, ">", -1)
    head = F.left(text, F.char_length(text) - F.char_length(tail))
    return F.when(F.contains(text, F.lit("<")) & F.contains(text, F.lit(">")), F.concat(F.regexp_replace(head, "<[^>]++>", ""), tail)).otherwise(text)


def strip(text: Column) -> Column:
    """Without white space at either end; texts that end in none are not searched for it."""
    return F.regexp_replace(F.when(F.right(text, F.lit(1)).rlike(_SPACE), F.regexp_replace(text, _TAIL, "")).otherwise(text), rf"^{_SPACE}+", "")


def _without_copyright(text: Column) -> Column:
    """Lower-cased, copyright notices cut; only texts with the word or the sign are searched for one."""
    out = F.lower(text)
    for pattern, needed in zip(_COPYRIGHT, ("copyright", "(c)"), strict=True):
        out = F.when(F.contains(out, F.lit(needed)), F.regexp_replace(out, pattern, "")).otherwise(out)
    return out


def strip_copyright(text: Column) -> Column:
    """Lower-cases, cuts copyright notices with a year to the end of their line, and trims."""
    return strip(_without_copyright(text))


def _words(text: Column) -> Column:
    """Lower-cased words, one space between: digits vanish, all that is neither letter nor numeral parts words."""
    parted = F.regexp_replace(F.regexp_replace(text, "[0-9]+", ""), "[^\\p{L}\\p{N}]+", " ")
    return F.trim(F.lower(parted))


def _joined(text: Column) -> Column:
    """The words run together, in one pass; but a capital sigma is lower-cased by where its word ends."""
    one = F.lower(F.regexp_replace(text, "[0-9[^\\p{L}\\p{N}]]+", ""))
    return F.nullif(F.when(F.contains(text, F.lit("\u03a3")), F.replace(_words(text), F.lit(" "), F.lit(""))).otherwise(one), F.lit(""))


def title_key(title: Column) -> Column:
    return _joined(strip_tags(unaccent(title)))


def abstract_key(abstract: Column) -> Column:
    # white space goes anyway, so it is not trimmed before
    return _joined(_without_copyright(strip_tags(unaccent(abstract))))


def names_key(names: Column) -> Column:
    """Array of names -> their last words, sorted by code point, joined by spaces."""
    kept = F.filter(names, lambda n: n.rlike(r"(?U)[^\s\x1c-\x1f]"))
    last = F.transform(kept, lambda n: F.lower(F.element_at(F.split(F.regexp_replace(n, _TAIL, ""), f"{_SPACE}+"), -1)))
    return F.nullif(_words(strip_tags(unaccent(F.array_join(F.array_sort(last), " ")))), F.lit(""))


def doi_key(doi: Column) -> Column:
    return strip(F.lower(doi))


#: What ``normalise`` does to each field; further fields can be added.
CLEANERS: dict[str, Callable[[Column], Column]] = {"title": title_key, "abstract": abstract_key, "last_names": names_key}


def normalise(df: DataFrame, fields: tuple[str, ...] = ("title", "abstract", "last_names")) -> DataFrame:
    """Adds ``{field}_norm`` for each field that ``df`` has; ``doi`` is cleaned in place.

    Works on batch and streaming DataFrames alike. Lowers the session's Arrow batches, as they hold whole texts. Raises ValueError for a field with no cleaner.
    """
    small_batches(df.sparkSession)
    out = df
    for field in fields:
        if field not in df.columns:
            continue
        if field == "doi":
            out = out.withColumn("doi", doi_key(F.col("doi")))
        elif field in CLEANERS:
            out = out.withColumn(f"{field}_norm", CLEANERS[field](F.col(field)))
        else:
            raise ValueError(f"no cleaner for the field {field!r}")
    return out
