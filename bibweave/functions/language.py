"""Language tags of text fields, by a detector that can be replaced.

Each field gets four columns: ``{field}_cld2_lid_success``, ``_is_reliable``,
``_first_result`` (a name) and ``_first_result_short_code``; the names of the
columns are part of the published schema.  ``learn`` fits a detector to texts of
known language: naive Bayes over character n-grams, whole batches at a time,
which is reliable where the best language is far ahead of the second.  Where
nothing is known, ``detect`` goes by script and, for Latin script, by frequent
short words. Both are deterministic, but their labels are their own: any function
can be given that maps a text to (name, code, reliable), or raises where it finds nothing.

Defined cases: for a null text, and where the detector fails, success is false
and the other three are null.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.functions import ngrams

#: Languages told by their script.
SCRIPTS = {
    "CYRILLIC": ("RUSSIAN", "ru"), "GREEK": ("GREEK", "el"), "HEBREW": ("HEBREW", "iw"), "ARABIC": ("ARABIC", "ar"), "HANGUL": ("Korean", "ko"),
    "HIRAGANA": ("Japanese", "ja"), "KATAKANA": ("Japanese", "ja"), "CJK": ("Chinese", "zh"), "DEVANAGARI": ("HINDI", "hi"), "THAI": ("THAI", "th"),
}
#: Frequent words and telling letters of languages in Latin script.
WORDS = {
    ("ENGLISH", "en"): "the of and to in is that for with as are this was on by we from be which an", ("GERMAN", "de"): "der die und das ist von den mit für auf ein eine nicht sich des dem werden zu im als",
    ("FRENCH", "fr"): "le la les des et une est dans pour que qui par sur du au avec pas sont ces aux", ("SPANISH", "es"): "el los las una que por con para del se es su como más son al lo entre sobre y",
    ("ITALIAN", "it"): "il che di della per con sono una gli nel del alla dei è non più anche le un si", ("PORTUGUESE", "pt"): "o os as um uma que para com do da em não dos das são mais no na ao por",
    ("DUTCH", "nl"): "de het een van en dat niet met voor zijn op aan ook worden bij uit naar door deze wordt",
}
MARKS = {"ENGLISH": "", "GERMAN": "äöüß", "FRENCH": "éèêçàâîôûœ", "SPANISH": "áéíóúñ¿¡", "ITALIAN": "àèìòù", "PORTUGUESE": "ãõçâêáó", "DUTCH": "ëï"}
_WORD = re.compile(r"[^\W\d_]+")
_KNOWN: dict[str, list[tuple[str, str]]] = {}
for _k, _v in WORDS.items():
    for _w in _v.split():
        _KNOWN.setdefault(_w, []).append(_k)


def detect(text: str) -> tuple[str, str, bool]:
    """(name, code, reliable); ValueError if the text has no letter."""
    words = Counter(_WORD.findall(text.lower()))
    letters = Counter()
    for w, n in words.items():
        for c in w:
            letters[c] += n
    if not letters:
        raise ValueError("no letters")
    scripts = Counter()
    for c, n in letters.items():
        scripts[unicodedata.name(c, "?").split(" ")[0].split("-")[0]] += n
    top, most = scripts.most_common(1)[0]
    if top in SCRIPTS:
        name, code = SCRIPTS["HIRAGANA"] if scripts["HIRAGANA"] + scripts["KATAKANA"] > 0.1 * most else SCRIPTS[top]
        return name, code, most >= 0.6 * scripts.total()
    points = Counter()
    for w, n in words.items():
        for lang in _KNOWN.get(w, ()):
            points[lang] += 4.0 * n / len(_KNOWN[w])
    for lang in WORDS:
        for c in MARKS[lang[0]]:
            points[lang] += letters[c] / (2 + len(MARKS[lang[0]]) / 4)
    ranked = sorted(((p, k) for k, p in points.items() if p > 0), key=lambda x: (-x[0], x[1]))
    if not ranked:
        return "Unknown", "un", False
    (best, (name, code)), second = ranked[0], ranked[1][0] if len(ranked) > 1 else 0.0
    return name, code, best >= 8 and best >= 1.3 * second


#: Names of languages by their codes; others are named by their code.
NAMES = {code: name for name, code in [*SCRIPTS.values(), *WORDS]}
#: Texts of each language that ``learn`` reads at most, about.
SAMPLE_ROWS = 2000
#: A result is reliable from this lead over the second language on, in nats a character, and in all.
LEAD_SHARE, LEAD = 0.02, 4.0


class Profiles:
    """A fitted detector. Called with a text it gives (name, code, reliable), as ``detect`` does; ``batch`` takes many."""

    def __init__(self, codes: list[str], matrix: np.ndarray):
        self.codes, self.matrix = codes, matrix

    def batch(self, texts: list[str | None]) -> list[tuple[str, str, bool] | None]:
        if not self.codes:
            return [None] * len(texts)
        z, seen = ngrams.sums(texts, self.matrix, np.zeros(len(self.codes), np.int64))
        order = np.argsort(-z, axis=1, kind="stable")
        out: list[tuple[str, str, bool] | None] = []
        for i, t in enumerate(texts):
            if not seen[i]:
                out.append(None)
                continue
            best = order[i, 0]
            lead = (z[i, best] - z[i, order[i, 1]]) / ngrams.SCALE if len(self.codes) > 1 else np.inf
            code = self.codes[best]
            out.append((NAMES.get(code, code.upper()), code, bool(lead >= LEAD and lead >= LEAD_SHARE * len(t))))
        return out

    def __call__(self, text: str) -> tuple[str, str, bool]:
        (found,) = self.batch([text])
        if found is None:
            raise ValueError("no letters")
        return found


def learn(df: DataFrame, text: str, code: str, sample_rows: int = SAMPLE_ROWS) -> Profiles:
    """Fits ``Profiles`` to texts and their language codes, on about ``sample_rows`` texts a language, by a hash of the text; copies count once.

    Rows with a null in either are left out, as are languages without letters.
    The profiles, 256 KB a language, are shipped with the function that uses them.
    """
    rows = df.select(F.col(code).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    many = rows.groupBy("lang").count().collect()  # one row a language
    if not many:
        return Profiles([], np.zeros((1 << ngrams.BITS, 0), np.int32))
    most = F.create_map(*(F.lit(x) for r in many for x in (r["lang"], sample_rows / r["count"] * (1 << 30))))
    kept = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.try_element_at(most, F.col("lang"))).distinct()
    counts = kept.mapInArrow(ngrams.counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    codes = sorted(set(counts["lang"].to_pylist()))
    return Profiles(codes, ngrams.log_probabilities(counts, codes) if codes else np.zeros((1 << ngrams.BITS, 0), np.int32))


def guess_bytes(raw: bytes) -> str:
    """Text of bytes in an unknown encoding: UTF-8 if they are valid, else Latin-1."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def tag(df: DataFrame, fields: tuple[str, ...] = ("title", "abstract"), detector: Callable[[str], tuple[str, str, bool]] = detect) -> DataFrame:
    """Adds the four columns for each field that ``df`` has."""

    @F.pandas_udf("success boolean, is_reliable boolean, first_result string, first_result_short_code string")
    def run(texts: pd.Series) -> pd.DataFrame:
        plain = [guess_bytes(t) if isinstance(t, bytes) else t for t in texts]
        found: list[tuple | None] = []
        if isinstance(detector, Profiles):
            found = detector.batch(plain)
        else:
            for t in plain:
                try:
                    found.append(detector(t) if t is not None else None)
                except (ValueError, UnicodeDecodeError):
                    found.append(None)
        rows = [(False, None, None, None) if f is None else (f[0] is not None, f[2], f[0], f[1]) for f in found]
        return pd.DataFrame(rows, columns=["success", "is_reliable", "first_result", "first_result_short_code"])

    out = df
    for f in (f for f in fields if f in df.columns):
        out = out.withColumn(f"_lid_{f}", run(F.col(f)))
    for f in (f for f in fields if f in df.columns):
        out = out.withColumns({f"{f}_cld2_lid_{x}": F.col(f"_lid_{f}.{x}") for x in ("success", "is_reliable", "first_result", "first_result_short_code")}).drop(f"_lid_{f}")
    return out
