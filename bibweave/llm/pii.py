"""Personal data by candidates and boosted trees, with DataFrame functions only.

1. Base rules find e-mail addresses, IPv4 addresses, card and phone numbers; what
   they accept is always redacted.
2. High-recall generators, several patterns a kind, propose spans, which may
   overlap: all that the base patterns match, accepted or not; written-out
   addresses ("name at host dot org" in brackets), IPv6 in full and compressed,
   phone numbers of one group or more, card numbers (by fours, or 4-6-5) next to
   other digits or with other separators, and strings that may be credentials.
3. Boosted trees, a set for each kind, score each proposal from its format
   (digits, groups, checksum, letters, length) and its context (telling words
   before and after, neighbours). They are fitted on the documents themselves:
   spans that a base rule accepts are personal data, those that fail a checksum,
   an octet or a number of digits are not; both are read in their context, as they
   stand and rewritten in other usual forms (``rewritten``), half of them without
   a telling word. Lines made here (``examples``) stand in for kinds that the
   documents lack. The trees become CASE expressions, so scoring stays in the JVM.
4. Scores are calibrated (Platt) on documents that were not fitted on, and each
   kind gets the least threshold that keeps ``PRECISION`` there. Accepted
   proposals that overlap a base span are dropped; of the others the longest are
   taken first (then the likelier), as long as they overlap none taken before.

Fitting reads at most about ``SAMPLE_DOCS`` documents, by a hash of id and text,
at most ``SPANS`` spans a kind of each, and ``SEEDS`` spans a kind and label of all
(the documented bounds); scoring reads all texts as a whole.

Positions are code points, ends exclusive. Patterns use possessive parts and
start anchors, so that runs of any length are read in linear time; they match
what the plain patterns match.

Defined cases: a null text is empty and has no spans; repeated rows each get
theirs; texts are read whole; an empty table gives an empty table. ``redact``
keeps all columns of its input, whatever their names, and never reads others
than the text and, for the sample, doc_id.
"""

from __future__ import annotations


import random

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The kinds of the base rules, and those that only the trees find.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
PRECISION = 0.97
CONTEXT = 32
#: Spans worked on at a time.
CHUNK = 256
#: Documents that the trees are fitted on and calibrated with, spans of a kind in one of them, and in all for each label.
SAMPLE_DOCS, SPANS, SEEDS = 20_000, 8, 500
#: Lines made for each form.
LINES = 60
TREES, DEPTH, RATE, BINS = 16, 4, 0.3, 24
#: Spans of documents of either label that a kind is calibrated on, or else made lines are, too.
LEAST_HELD = 20

_W = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_W}])|\G)[{_W}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Cheap tests that a text must pass before positions are worked out.
GUARD = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){12}",
    "phone": r"\+[0-9]",
}
#: Tests that are plain substrings.
PLAIN = ("@", "::")
_AT, _DOT = r"\s?(?:\(at\)|\[at\]|\{at\}|<at>)\s?", r"\s?(?:\(dot\)|\[dot\]|\{dot\}|<dot>)\s?"
#: Generators besides the base patterns, several a kind: pattern, and a cheap test that each of its matches passes.
MORE = {
    "email": [(rf"(?i)(?<![{_W}])[{_W}]{{1,64}}+{_AT}[A-Z0-9-]{{1,63}}+(?:(?:{_DOT}|\.)[A-Z0-9-]{{1,63}}+){{1,8}}+", r"(?i)[(\[{<]at[)\]}>]")],
    "ip": [
        (r"(?i)(?<![0-9a-z:.])(?:[0-9a-f]{1,4}:){3,7}+[0-9a-f]{1,4}(?![0-9a-z:])", r"(?i)[0-9a-f]:[0-9a-f]{1,4}:[0-9a-f]"),
        # compressed
        (r"(?i)(?<![0-9a-z:.])(?:(?:[0-9a-f]{1,4}:){1,7}+:(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,5}+)?+|::[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,6}+)(?![0-9a-z:])", "::"),
    ],
    "card": [
        (r"(?<![0-9])[0-9]{4}(?:([ ._/-])[0-9]{4}\1[0-9]{4}\1|[0-9]{8})[0-9]{1,7}(?![0-9])", r"[0-9]{4}[ ._/-]?[0-9]{4}[ ._/-]?[0-9]{4}"),
        # groups of four, six and the rest
        (r"(?<![0-9])[0-9]{4}([ ._/-])[0-9]{6}\1[0-9]{4,5}(?![0-9])", r"[0-9]{4}[ ._/-][0-9]{6}[ ._/-][0-9]{4}"),
    ],
    "phone": [
        (r"(?<![0-9A-Za-z+.=#_-])(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-]|00[0-9]{1,3}[ .-])(?:[0-9]{2,4}[ .-]){1,3}[0-9]{2,4}(?![0-9A-Za-z])", r"[0-9]{2}(?:\)[ .-]?|[ .-])[0-9]{2,4}[ .-][0-9]{2}"),
        # two groups
        (r"(?<![0-9A-Za-z+.=#_-])(?:\([0-9]{2,5}\)[ ./-]?|[0-9]{2,5}[ ./-])[0-9]{3,9}(?![0-9A-Za-z])", r"[0-9]{2}(?:\)[ ./-]?|[ ./-])[0-9]{3}"),
        # one group
        (r"(?<![0-9A-Za-z+.=#_-])[0-9]{9,12}(?![0-9A-Za-z])", "[0-9]{9}"),
    ],
    "secret": [
        # letters and digits in one run
        (r"(?<![A-Za-z0-9+/_=.-])(?=[A-Za-z_+/-]{0,64}[0-9])(?=[0-9_+/-]{0,64}[A-Za-z])[A-Za-z0-9_+/-]{16,256}+={0,2}(?![A-Za-z0-9+/_@=])", "[0-9][A-Za-z_+/-]|[A-Za-z_+/-][0-9]"),
    ],
}
#: Words that tell, by kind, and words that tell against.
TELLING = {
    "email": r"mail|contact|write|reach|kontakt|correo|courriel|@",
    "ip": r"\bip|host|server|addr|connect|login|serveur|servidor",
    "card": r"card|visa|credit|pay|karte|carte|tarjeta",
    "phone": r"phone|tel|call|fax|mobile|contact|appel|llam|ruf",
    "secret": r"token|secret|passw|api.?key|\bkey|auth|bearer|credential|clave|schlüssel",
}
AGAINST = r"version|isbn|issn|page|order|serial|total|score|id:|no\.|ticket|figure|section|date|ratio|time|commit|sha|md5|digest|checksum|uuid|revision"
#: What is put before rewritten spans: words that tell, and words that tell against.
LEADS = {"email": ("contact", "mail"), "ip": ("host", "server ip", "login from"), "card": ("card", "visa", "pay with"), "phone": ("phone", "call", "tel", "mobile", "fax"), "secret": ("token =", "api_key:", "password =", "secret:")}
OTHERS = ("order", "serial", "page", "ticket", "total", "date", "version", "time", "commit", "md5")


def _chunked(array: Column, use) -> Column:
    """``use(i, part)`` for each run of CHUNK items: keeps the work of growing arrays near linear."""

    def parts(a: Column) -> Column:
        last = F.ceil(F.size(a) / F.lit(CHUNK)).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: use(i, F.slice(a, i * CHUNK + 1, CHUNK)))

    # an array of one gives the array a name; else it is worked out anew for each run
    return F.element_at(F.transform(F.array(array), parts), 1)


def found(text: Column, pattern: str, guard: str, keep, need: Column | None = None) -> Column:
    """Array of (start, end, value) of all matches for which ``keep(value)`` holds; none where ``need``, if given, is false."""
    parts, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    steps = F.zip_with(parts, values, lambda p, v: F.struct(F.char_length(p).alias("skip"), v.alias("value")))
    nothing = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, x):
        start = acc["at"] + x["skip"]
        end = start + F.coalesce(F.char_length(x["value"]), F.lit(0))
        more = F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        return F.struct(end.alias("at"), F.when(x["value"].isNotNull() & keep(x["value"]), F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

    def shift(acc, x):
        moved = F.transform(x["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["value"].alias("value")))
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    chunks = _chunked(steps, lambda i, part: F.aggregate(part, nothing, step))
    spans = F.aggregate(chunks, nothing, shift, lambda acc: acc["out"])
    sure = F.contains(text, F.lit(guard)) if guard in PLAIN else text.rlike(guard)
    return F.when(sure if need is None else need & sure, spans).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")
    each = F.transform(F.filter(back, lambda d: d != ""), lambda d, i: F.when(i % 2 == 1, F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
ACCEPT = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"),
    "card": lambda v: F.when(F.char_length(_digits(v)).between(13, 19), luhn(_digits(v))).otherwise(F.lit(False)),
    "phone": lambda v: F.char_length(_digits(v)).between(9, 15),
}
PROPOSE = ACCEPT | {
    "ip": lambda v: F.lit(True),
    "card": lambda v: F.char_length(_digits(v)).between(13, 19),
    "phone": lambda v: F.char_length(_digits(v)).between(7, 15),
    "secret": lambda v: F.lit(True),
}

FEATURES = (
    "kind", "length", "digits", "distinct", "groups", "luhn", "zero", "bracket", "colons", "separators", "longest", "telling", "against", "tight", "first",
    "plus", "greatest", "letters", "characters", "hex", "assigned", "dots", "domain", "cases", "head", "tail",
)


def _features(kind: str, text: Column, s: Column) -> Column:
    """Numbers that the trees see, in the order of FEATURES."""
    v = s["value"]
    d = _digits(v)
    before = F.lower(F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT))))
    after = F.lower(F.substring(text, s["end"] + 1, F.lit(CONTEXT)))
    groups = F.filter(F.split(v, "[^0-9]+"), lambda g: g != "")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    count = lambda c, keep: F.char_length(F.regexp_replace(c, f"[^{keep}]", "")).cast("double")
    size = lambda g: F.coalesce(F.char_length(g), F.lit(0)).cast("double")
    return F.array(
        F.lit(float(KINDS.index(kind))), F.char_length(v).cast("double"), F.char_length(d).cast("double"),
        F.size(F.array_distinct(F.split(d, ""))).cast("double"), F.size(groups).cast("double"),
        flag(luhn(d)) if kind == "card" else F.lit(0.0), flag(v.startswith("0")), flag(v.rlike(r"[(\[{<]")), count(v, ":"),
        F.size(F.array_distinct(F.filter(F.split(F.regexp_replace(v, "[A-Za-z0-9]", ""), ""), lambda c: c != ""))).cast("double"),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.char_length(g))), F.lit(0)).cast("double"),
        flag(before.rlike(TELLING[kind]) | after.rlike(TELLING[kind])), flag(before.rlike(AGAINST)),
        flag(before.rlike(r"[\w=#$€/.-]$") | after.rlike(r"^(?:[\w=#$€%/]|[.,][0-9])")), F.coalesce(F.try_element_at(groups, F.lit(1)).cast("double"), F.lit(-1.0)),
        flag(v.startswith("+")), F.coalesce(F.array_max(F.transform(groups, lambda g: g.cast("double"))), F.lit(-1.0)), count(v, "A-Za-z"),
        F.size(F.array_distinct(F.split(v, ""))).cast("double"), flag(v.rlike("^[0-9a-fA-F]+$")), flag(before.rlike("[=:] ?[\"']?$")), count(v, "."),
        flag(v.rlike(r"[.][A-Za-z]{2,}$")), flag(v.rlike("[a-z]")) + flag(v.rlike("[A-Z]")) + flag(v.rlike("[0-9]")) + flag(v.rlike("[_+/=-]")),
        size(F.try_element_at(groups, F.lit(1))), size(F.try_element_at(groups, F.lit(-1))),
    )


_SPANS = "array<struct<start:int,end:int,value:string>>"


def matched(kind: str, text: Column, digit: Column | None = None) -> Column:
    """(start, end, value) of all matches of a kind's base pattern that may be worth a look. ``digit``: whether the text has one."""
    return found(text, BASE[kind], GUARD[kind], PROPOSE[kind], None if kind == "email" else digit)


def accepted(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: F.coalesce(ACCEPT[kind](s["value"]), F.lit(False)))


def proposed(kind: str, text: Column, spans: Column | None, digit: Column | None = None) -> Column:
    """What the generators of a kind propose, the matches of its base pattern (``spans``) first."""
    more = [found(text, pattern, guard, PROPOSE[kind], digit if kind in ("card", "phone", "secret") else None) for pattern, guard in MORE[kind]]
    return F.concat(*([] if spans is None else [spans]), *more)


def described(kind: str, text: Column, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), _features(kind, text, s).alias("x")))


def examples(seed: int = 5) -> list[tuple[int, int, str, str, str]]:
    """(kind, 1 or 0, before, value, after): lines made here, half of them without a word that tells."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    x = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n - 2)) + r.choice("aK") + r.choice("37")
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(3, 8)))
    say = lambda *options: r.choice(options)

    def card(valid: bool, size: int = 16) -> str:
        body = ((say("4", "51", "37", "6011") if size == 16 else say("34", "37")) + d(20))[: size - 1]
        total = sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(body)))
        check = (-total) % 10
        return body + str(check if valid else (check + r.randint(1, 9)) % 10)

    def parted(n: str, sep: str) -> str:
        return sep.join(n[i : i + 4] for i in range(0, len(n), 4)) if len(n) == 16 else sep.join((n[:4], n[4:10], n[10:]))

    out: list[tuple[int, int, str, str, str]] = []

    def add(kind: str, good: int, value: str, tell: bool | None = None) -> None:
        tell = r.random() < 0.5 if tell is None else tell
        lead = say(*(LEADS[kind] if good else OTHERS)) if tell else word()
        out.append((KINDS.index(kind), good, f"{word()} {word()} {lead} ", value, f" {word()} {word()}"))

    for _ in range(LINES):
        at, dot, gap = say("(at)", "[at]", "{at}"), say("(dot)", "[dot]", "{dot}"), say(" ", "")
        add("email", 1, f"{word()}.{word()}{gap}{at}{gap}{word()} {dot} {say('com', 'org', 'net', 'de', 'es')}")
        add("email", 1, f"{word()}{say('', '.', '_')}{d(2)}@{word()}{say('', d(1))}.{say('com', 'org', 'example.net', 'de')}")
        add("email", 0, f"{word()} {at} {d(2)}{dot}{d(2)}")
        add("ip", 1, ".".join(str(r.randint(1, 255)) for _ in range(4)))
        add("ip", 0, ".".join(str(r.randint(0, 999)) for _ in range(3)) + f".{r.randint(256, 9999)}")
        add("ip", 1, ":".join(f"{r.getrandbits(16):x}" for _ in range(8)))
        v6 = [f"{r.getrandbits(16):x}" for _ in range(6)]
        add("ip", 1, say(f"{v6[0]}:{v6[1]}::{r.randint(1, 255):x}", f"fe80::{':'.join(v6[: r.randint(1, 4)])}", f"2001:db8::{':'.join(v6[: r.randint(1, 3)])}", f"2001:db8:{v6[0]}::", f"::ffff:{v6[1]}:{v6[2]}"))
        add("ip", 0, say(f"{d(2)}:{d(2)}:{d(2)}:{d(2)}", ":".join(x(2) for _ in range(6)), f"{d(2)}::{d(2)}", f"{d(1)}::{d(1)}", "ab::cd", "add::be", "dec::", "::a", "face::feed", "::"))
        for size in (16, 15):
            sep = say(" ", "-", ".", "_", "/")
            for good in (1, 0):
                add("card", good, say(card(bool(good), size), parted(card(bool(good), size), sep)))
                out.append((2, good, f"{word()} {say('card', 'visa', word()) if good else say('serial', 'order', word())} {say(d(2), d(1), d(3))} ", parted(card(bool(good), size), sep), f" {word()}"))
        # of one group, or two short ones: only with a word that tells
        add("phone", 1, say(f"0{d(3)} {d(7)}", f"0{d(2)} {d(6)}", f"0{d(3)}/{d(6)}", f"(0{d(2)}) {d(7)}", f"(0{d(3)}){d(6)}", f"{say('2', '3', '5', '7', '9')}{d(9)}", f"0{d(10)}", f"{d(3)}-{d(4)}"), True)
        add("phone", 1, say(f"({d(3)}) {d(3)}-{d(4)}", f"({d(3)}){d(3)}-{d(4)}", f"{say('2', '3', '5', '7', '9')}{d(2)}-{d(3)}-{d(4)}", f"0{d(2)} {d(4)} {d(4)}", f"00{d(2)} {d(3)} {d(3)} {d(3)}", f"+{d(2)} {d(3)} {d(3)} {d(3)}"))
        add("phone", 0, say(f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)} {d(3)} {d(3)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(2)}.{d(2)}.{d(4)}", f"20{d(2)}-0{d(1)}-{d(2)}"))
        add("phone", 0, say(d(10), d(9), d(11), f"{d(4)} {d(7)}", f"{d(3)} {d(6)}", f"{d(5)}-{d(4)}", f"{d(4)}/{d(4)}", f"{d(4)}-{d(4)}", f"{d(3)} {d(3)} {d(3)}", f"19{d(2)}-20{d(2)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}"))
        secret = say(x(40), x(32), mixed(32), mixed(40), f"ghp_{mixed(36)}", f"AKIA{mixed(16).upper()}", f"sk-{mixed(40)}")
        mark = say('"', "'", "")
        out.append((4, 1, f"{word()} {say(*LEADS['secret'], 'auth', 'bearer', 'access_key =')} {mark}", secret, f"{mark} {word()}"))
        out.append((4, 1, f"{word()} {word()} = {say(chr(34), chr(39))}", say(x(40), mixed(32), f"ghp_{mixed(36)}"), f'" {word()}'))
        out.append((4, 0, f"{word()} {say('commit', 'md5', 'sha', 'checksum', 'digest', 'uuid', 'revision', 'order', 'file', word(), word())}{say(' ', ': ')}", say(x(40), x(32), x(64), "-".join((x(8), x(4), x(4), x(4), x(12)))), f" {word()}"))
        out.append((4, 0, f"{word()} {word()} {say('', 'see ', 'key ')}", say(f"{word()}-{word()}-{word()}-{d(2)}", f"{word()}_{word()}_{word()}{d(1)}", f"/{word()}/{word()}/{word()}{d(3)}", f"{word()}{word()}{word()}{d(4)}", f"{word()}+{word()}+{word()}+{d(1)}"), f" {word()}"))
    return out


def _seeds(docs: DataFrame, text: str) -> DataFrame:
    """(h, kind, y, before, value, after): spans of a bounded sample of documents that the base rules judge."""
    id_ = F.col("doc_id").cast("string") if "doc_id" in docs.columns else F.lit(None).cast("string")
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    kept = docs.select(F.pmod(F.xxhash64(F.lit(41), id_, F.col(f"`{text}`")), F.lit(1 << 30)).alias("h"), F.col(f"`{text}`").alias("t")).where(F.col("t").isNotNull() & (F.col("h") < int(share * (1 << 30)))).withColumn("digit", F.col("t").rlike("[0-9]"))
    t = F.col("t")
    parts = []
    for k, kind in enumerate(KINDS):
        if kind in BASE_KINDS:
            spans, good = matched(kind, t, F.col("digit")), lambda s, before, kind=kind: F.coalesce(ACCEPT[kind](s["value"]), F.lit(False))
        else:
            # a credential is what a name of one is given; one that stands after a word against is none
            spans = found(t, *MORE[kind][0], PROPOSE[kind], F.col("digit"))
            good = lambda s, before: F.when(before.rlike(rf"(?i)(?:{TELLING['secret']})\w* ?[=:] ?[\"']?$"), True).when(F.lower(before).rlike(AGAINST), False)

        def seed(s, k, good):
            before = F.substring(t, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
            return F.struct(F.lit(k).alias("kind"), good(s, before).cast("int").alias("y"), before.alias("before"), s["value"].alias("value"), F.substring(t, s["end"] + 1, F.lit(CONTEXT)).alias("after"))

        parts.append(F.transform(F.slice(spans, 1, SPANS), (lambda k, good: lambda s: seed(s, k, good))(k, good)))
    rows = kept.select("h", F.explode(F.concat(*parts)).alias("s")).select("h", "s.*").where("y is not null").distinct()
    order = F.row_number().over(Window.partitionBy("kind", "y").orderBy(F.xxhash64("h", "value"), "before", "after"))
    return rows.withColumn("_n", order).where(F.col("_n") <= SEEDS).drop("_n")


def rewritten(seeds: DataFrame) -> DataFrame:
    """Seeds as they stand, and in other usual forms of the same data; half of these after a word that tells."""
    rows = seeds.withColumn("m", F.md5(F.concat_ws("/", F.col("h").cast("string"), "value").cast("binary"))).withColumn("d", F.regexp_replace("value", "[^0-9]", ""))
    n = lambda at: F.conv(F.substring("m", at, 2), 16, 10).cast("int")  # noqa: E731  a number below 256 of the seed's own
    of = lambda at, *options: F.element_at(F.array(*(F.lit(o) if isinstance(o, str) else o for o in options)), n(at) % len(options) + 1)
    cut = lambda a, size: F.substring("nat", a, size)
    joined = lambda sep, *parts: F.concat(parts[0], *(c for p in parts[1:] for c in (sep, p)))
    rows = rows.withColumn("nat", F.regexp_replace(F.regexp_replace("value", r"^\+[0-9]{1,3}(?=[^0-9])", ""), "[^0-9]", ""))
    forms = []

    def form(kind: str, when: Column, y: int, value: Column, at: int, tell: str = "half") -> None:
        lead = F.concat(of(at + 2, *(LEADS[kind] if y else OTHERS)), F.lit(" "))
        before = {"half": F.when(n(at) % 2 == 0, lead).otherwise(F.lit("")), "always": lead, "never": F.lit("")}[tell]
        forms.append(F.when(when, F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.lit(y).alias("y"), F.concat(F.regexp_replace("before", r"(?:\S+\s*){1,3}$", ""), before).alias("before"), value.alias("value"), F.concat(F.lit(" "), F.regexp_replace("after", r"^\S+", "")).alias("after"))))

    good = F.col("y") == 1
    mail, ip, card, phone, secret = (F.col("kind") == i for i in range(5))
    at, dot = of(3, " (at) ", "(at)", " [at] ", "{at}"), of(5, " (dot) ", " [dot] ", ".", "{dot}")
    form("email", mail & good, 1, F.concat(F.substring_index("value", "@", 1), at, F.regexp_replace(F.substring_index("value", "@", -1), F.lit("[.]"), dot)), 7)
    group = lambda i: F.regexp_replace(F.substring("m", 1 + 4 * i, 4), "^0+(?=.)", "")
    form("ip", ip & good, 1, F.concat_ws(":", *(group(i) for i in range(8))), 9)
    form("ip", ip & good, 1, of(11, F.concat(F.lit("2001:db8::"), group(1)), F.concat(F.lit("fe80::"), group(0), F.lit(":"), group(1), F.lit(":"), group(2)), F.concat(group(3), F.lit(":"), group(4), F.lit("::"), group(5)), F.concat(F.lit("2001:db8:"), group(0), F.lit("::"))), 13)
    form("ip", ip & good, 0, F.concat(n(3) + 256, F.lit("."), F.substring_index("value", ".", -3)), 15)
    form("ip", ip & good, 0, F.format_string("%02d:%02d:%02d:%02d", n(3) % 24, n(5) % 60, n(7) % 60, n(9) % 100), 15)
    wrong = F.concat(F.expr("substring(d, 1, length(d) - 1)"), ((F.substring("d", -1, 1).cast("int") + 1 + n(3) % 9) % 10).cast("string"))
    for y, digits in ((1, F.col("d")), (0, wrong)):
        form("card", card & good & (F.char_length("d") == 16), y, joined(of(5, " ", "-", ".", "_", "/"), *(F.substring(digits, i, 4) for i in (1, 5, 9, 13))), 17)
        form("card", card & good, y, digits, 19)
    ten = phone & good & F.char_length("nat").between(9, 11)
    form("phone", ten, 1, F.concat(F.lit("("), cut(1, 3), of(3, ") ", ")"), cut(4, 3), F.lit("-"), F.expr("substring(nat, 7)")), 21)
    form("phone", ten, 1, joined(of(5, "-", " ", "."), cut(1, 3), cut(4, 3), F.expr("substring(nat, 7)")), 23)
    form("phone", ten, 1, F.concat(F.lit("00"), F.regexp_replace("value", "^\\+|[()]", "")), 25)
    form("phone", ten, 1, F.col("nat"), 25, "always")
    form("phone", ten, 0, F.col("nat"), 27, "never")
    form("phone", ten, 0, of(7, F.format_string("20%02d-%02d-%02d", n(3) % 30, n(5) % 12 + 1, n(7) % 28 + 1), F.format_string("%02d.%02d.19%02d", n(7) % 28 + 1, n(5) % 12 + 1, n(3) % 100), F.concat_ws(" ", cut(4, 2), cut(6, 3), cut(7, 3)), F.format_string("19%02d-20%02d", n(3) % 100, n(5) % 30), F.concat(F.lit("978-"), cut(1, 1), F.lit("-"), cut(2, 2), F.lit("-"), cut(4, 6), F.lit("-"), cut(9, 1))), 29)
    form("secret", secret & good, 1, F.col("value"), 9, "always")
    form("secret", secret & good, 0, F.regexp_replace("value", "[^A-Za-z0-9]", ""), 11, "never")
    own = F.struct("kind", "y", "before", "value", "after")
    return rows.select("h", F.explode(F.filter(F.array(own, *forms), lambda s: s.isNotNull())).alias("s")).select("h", "s.*")


def _judged(lines: DataFrame) -> DataFrame:
    """(h, kind, y, before, value, after) -> (h, y, x) of the proposals of each line that its label says something about."""
    rows = lines.select("h", "kind", "y", F.concat("before", "value", "after").alias("t"), F.char_length("before").alias("a"), (F.char_length("before") + F.char_length("value")).alias("b"))
    t = F.col("t")
    every = F.concat(*(described(k, t, proposed(k, t, matched(k, t) if k in BASE_KINDS else None)) for k in KINDS))
    c = rows.select("h", F.col("kind").alias("own"), "y", "a", "b", F.explode(every).alias("c")).where("c.start < b AND a < c.end")
    same = F.col("c.kind") == F.col("own")
    exact = (F.col("c.start") == F.col("a")) & (F.col("c.end") == F.col("b"))
    # part of what is personal data, of its own kind: neither right nor wrong
    label = F.when(F.col("y") == 0, F.lit(0)).when(same & exact, F.lit(1)).when(~same, F.lit(0))
    return c.select("h", label.alias("y"), F.col("c.x").alias("x")).where("y is not null")


def _binned(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    cuts = [np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1])) if len(v) else np.empty(0) for v in x.T]
    return np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)], axis=1), cuts


def _grow(b: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int):
    """A regression tree on gradients, from sums by bin: (feature, cut, left, right) or a leaf's value."""
    whole_g, whole_h = g[rows].sum(), h[rows].sum()
    leaf = float(RATE * whole_g / (whole_h + 1.0))
    if depth == 0 or len(rows) < 8:
        return leaf
    best = (1e-6, None, None)
    for f, c in enumerate(cuts):
        if len(c):
            v = b[rows, f]
            n, sg, sh = (np.cumsum(np.bincount(v, weights=w, minlength=len(c) + 1))[:-1] for w in (None, g[rows], h[rows]))
            gain = sg**2 / (sh + 1.0) + (whole_g - sg) ** 2 / (whole_h - sh + 1.0) - whole_g**2 / (whole_h + 1.0)
            gain[(n < 4) | (n > len(rows) - 4)] = 0
            if gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
    if best[1] is None:
        return leaf
    left = b[rows, best[1]] <= best[2]
    return (best[1], float(cuts[best[1]][best[2]]), _grow(b, cuts, g, h, rows[left], depth - 1), _grow(b, cuts, g, h, rows[~left], depth - 1))


def _run(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, a, b = tree
    return np.where(x[:, f] <= cut, _run(a, x), _run(b, x))


class Model:
    """For each kind: trees, the slope and offset of the calibration, and a threshold."""

    def __init__(self, trees: list[list], slopes: list[float], offsets: list[float], thresholds: list[float]):
        self.trees, self.slopes, self.offsets, self.thresholds = trees, slopes, offsets, thresholds

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        out = np.zeros(len(x))
        for k in range(len(KINDS)):
            own = x[:, 0] == k
            z = sum((_run(t, x[own]) for t in self.trees[k]), np.zeros(own.sum()))
            out[own] = 1 / (1 + np.exp(-(self.slopes[k] * z + self.offsets[k])))
        return out

    def probability(self, kind: str, x: str) -> str:
        """SQL for the calibrated probability, given that of the kind and of the feature array."""

        def case(tree) -> str:
            if not isinstance(tree, tuple):
                return f"{tree!r}D"
            f, cut, a, b = tree
            return f"CASE WHEN {x}[{f}] <= {cut!r}D THEN {case(a)} ELSE {case(b)} END"

        each = (f"WHEN {k} THEN 1D / (1D + exp(-({self.slopes[k]!r}D * ({' + '.join(['0D', *map(case, self.trees[k])])}) + {self.offsets[k]!r}D)))" for k in range(len(KINDS)))
        return f"CASE {kind} {' '.join(each)} END"


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Fits on two thirds of a bounded sample and calibrates on the documents of the last third, which no tree has seen."""
    made = "\n".join("\t".join(map(str, e)) for e in examples())
    f = F.split("line", "\t")
    # made lines have negative hashes
    lines = docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit(made), "\n")).alias("i", "line")).select((-1 - F.pmod(F.xxhash64("i"), F.lit(1 << 30))).alias("h"), f[0].cast("int").alias("kind"), f[1].cast("int").alias("y"), f[2].alias("before"), f[3].alias("value"), f[4].alias("after"))
    seen = _judged(lines.unionByName(rewritten(_seeds(docs, text)))).collect()  # bounded by SEEDS
    seen.sort(key=lambda r: (r["h"], r["y"], r["x"]))
    x, y, h = np.array([r["x"] for r in seen]), np.array([float(r["y"]) for r in seen]), np.array([r["h"] for r in seen])
    fitting = np.abs(h) % 3 != 0
    model = Model([], [], [], [])
    for k in range(len(KINDS)):
        own, ours = (x[:, 0] == k) & fitting, (x[:, 0] == k) & ~fitting
        b, cuts = _binned(x[own])
        trees, z = [], np.zeros(own.sum())
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            trees.append(_grow(b, cuts, y[own] - p, p * (1 - p), np.arange(len(z)), DEPTH))
            z = z + _run(trees[-1], x[own])
        real = ours & (h >= 0)
        ours = real if y[real].sum() >= LEAST_HELD and (1 - y[real]).sum() >= LEAST_HELD else ours
        zc, yc = sum((_run(t, x[ours]) for t in trees), np.zeros(ours.sum())), y[ours]
        slope, offset = 1.0, 0.0
        for _ in range(500):  # Platt: a logistic curve over the margins of what was kept back
            p = 1 / (1 + np.exp(-(slope * zc + offset)))
            slope, offset = slope + 0.05 * float((yc - p) @ zc / len(yc) - 1e-3 * (slope - 1)), offset + 0.5 * float((yc - p).mean())
        p = 1 / (1 + np.exp(-(slope * zc + offset)))
        cuts = [c for c in sorted(set(np.round(p, 6).tolist())) if c >= 0.5 and yc[p >= c - 1e-6].mean() >= PRECISION]
        model.trees.append(trees)
        model.slopes.append(float(slope))
        model.offsets.append(float(offset))
        model.thresholds.append(float(cuts[0] - 1e-6) if cuts else 2.0)
    return model


def detect(docs: DataFrame, text: str = "text", model: Model | None = None, base: bool = True) -> DataFrame:
    """Adds ``_base`` and ``_all``: arrays of (kind, start, end), ordered by kind, then start. Input columns of these names are replaced.

    With ``base`` off nothing is accepted but what the trees accept.
    """
    model = model or fit(docs, text)
    t = F.coalesce(F.col(text), F.lit(""))
    # columns of their own, so that each is worked out once
    at = docs.withColumn("_digit", t.rlike("[0-9]"))
    at = at.withColumns({f"_m_{k}": matched(k, t, F.col("_digit")) for k in BASE_KINDS})
    plain = lambda k: lambda s: F.struct(F.lit(KINDS.index(k)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    sure = F.concat(*(F.transform(accepted(k, F.col(f"_m_{k}")), plain(k)) for k in BASE_KINDS))
    at = at.withColumn("_base", sure if base else F.array().cast("array<struct<kind:int,start:int,end:int>>"))
    free = lambda spans: F.filter(spans, lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    # what a base rule accepts needs no proposal: texts with very many such spans are not compared with themselves
    left = {k: F.filter(f"_m_{k}", (lambda k: lambda s: ~F.coalesce(ACCEPT[k](s["value"]), F.lit(False)))(k)) if base else F.col(f"_m_{k}") for k in BASE_KINDS}
    at = at.withColumns({f"_p_{k}": free(proposed(k, t, left.get(k), F.col("_digit"))) for k in KINDS})
    at = at.withColumn("_p", F.concat(*(described(k, t, F.col(f"_p_{k}")) for k in KINDS))).drop("_digit", *(f"_m_{k}" for k in BASE_KINDS), *(f"_p_{k}" for k in KINDS))
    limits = f"array({', '.join(f'{float(x)!r}D' for x in model.thresholds)})"
    scored = f"transform(_p, c -> struct(c.kind AS kind, c.start AS start, c.end AS end, {model.probability('c.kind', 'c.x')} AS p))"
    at = at.withColumn("_m", F.expr(f"CASE WHEN size(_p) > 0 THEN filter({scored}, c -> c.p >= {limits}[c.kind]) END")).drop("_p")
    ranked = "array_sort(transform(_m, c -> struct(c.start - c.end AS r, -c.p AS q, c.start AS start, c.kind AS kind, c.end AS end)))"
    none = "cast(array() AS array<struct<r:int,q:double,start:int,kind:int,end:int>>)"
    best = f"aggregate({ranked}, {none}, (acc, c) -> IF(exists(acc, o -> o.start < c.end AND c.start < o.end), acc, concat(acc, array(c))))"
    extra = f"transform({best}, c -> struct(c.kind AS kind, c.start AS start, c.end AS end))"
    return at.withColumn("_all", F.expr(f"CASE WHEN size(_m) > 0 THEN array_sort(concat(_base, {extra})) ELSE _base END")).drop("_m")


def listed(spans_: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans, n_added, n_spans."""
    at = detect(docs.select("doc_id", "text"), model=model)
    of_kind = lambda i: F.filter(F.col("_base"), lambda s: s["kind"] == i)
    many = [F.size(of_kind(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    digest = F.sha2(listed(F.col("_base")).cast("binary"), 256)
    return at.select("doc_id", *many, digest.alias("base_sha256"), listed(F.col("_all")).alias("spans"), (F.size("_all") - F.size("_base")).cast("long").alias("n_added"), F.size("_all").cast("long").alias("n_spans"))


def redact(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """The same rows and columns; each span gives way to its kind in brackets."""
    model = model or fit(docs, text)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    prefix = "_pii_in_"  # input columns keep clear of the ones made here
    inner = docs.select(*(F.col(f"`{c}`").alias(f"{prefix}{i}") for i, c in enumerate(docs.columns)))
    own = f"{prefix}{docs.columns.index(text)}"
    at = detect(inner, own, model)
    by_start = F.array_sort(F.transform(F.col("_all"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    at = at.withColumn("_by", by_start).withColumn("_ends", F.transform("_by", lambda s: s["end"]))

    def piece(i, part):
        """Text from where the spans before end to where these end, with these replaced."""
        begin = F.coalesce(F.array_max(F.slice("_ends", 1, i * CHUNK)), F.lit(0))
        last = (i + 1) * CHUNK >= F.size("_by")
        finish = F.when(last, F.char_length(own)).otherwise(F.array_max(F.slice("_ends", 1, (i + 1) * CHUNK)))
        # a struct in an array of one: names for what is used again and again
        given = F.array(F.struct(begin.alias("begin"), finish.alias("finish"), F.substring(F.col(own), begin + 1, finish - begin).alias("text")))

        def one(g):
            def step(acc, s):
                gap = F.substring(g["text"], acc["at"] - g["begin"] + 1, s["start"] - acc["at"])
                out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, names[s["kind"]])).otherwise(acc["out"])
                return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

            start = F.struct(g["begin"].alias("at"), F.lit("").alias("out"))
            return F.aggregate(part, start, step, lambda acc: F.concat(acc["out"], F.substring(g["text"], acc["at"] - g["begin"] + 1, F.greatest(g["finish"] - acc["at"], F.lit(0)))))

        return F.array_join(F.transform(given, one), "")

    clean = F.array_join(_chunked(F.col("_by"), piece), "")
    value = F.when(F.size("_all") > 0, clean).otherwise(F.col(own))
    return at.select(*((value if c == text else F.col(f"{prefix}{i}")).alias(c) for i, c in enumerate(docs.columns)))
