"""Personal data by patterns, checksums and context, in built-in functions only.

A pattern proposes spans, a checksum or a range confirms them (Luhn for cards, modulo 97 for bank
account numbers, 255 for address parts, digit counts for phones), and words nearby raise or lower
the score of what no checksum proves. Positions come from the text between the matches: what
precedes match i are i + 1 pieces and i matches, whose lengths are summed. They count code points.

The patterns are possessive, and those that could start anywhere in a long run start at its
beginning or where the last match ended, so the time is linear in the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import let, text_of

LOCAL = "A-Za-z0-9._%+-"
#: Characters of a bank account number by country.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 "
    "EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 "
    "JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 "
    "NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 "
    "TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30 "
)


def _iban_pattern() -> str:
    """Numbers of the length of their country, whatever follows after a space; else as many groups
    as there are, up to the next such number."""
    countries: dict[int, list[str]] = {}
    for entry in IBAN_LENGTHS.split():
        countries.setdefault(int(entry[2:]), []).append(entry[:2])
    known = "|".join(
        rf"(?:{'|'.join(names)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+" for n, names in sorted(countries.items())
    )
    known = rf"(?:{known})(?![A-Za-z0-9])"
    other = rf"[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20(?!{known}))?[A-Z0-9]){{11,30}}+(?![A-Za-z0-9])"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{known}|{other})"


PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban_pattern(),
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
#: The kinds whose spans are kept whatever their score, in the order of the listing.
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)
#: Score of a confirmed span without any context.
PRIOR = {"email": 0.95, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "national_id": 0.4}
#: Words that make a span likelier (for the kind) or unlikelier (for all), within 40 characters and
#: not beyond another match of the kind's pattern.
NEAR = 40
SUPPORT = {
    "email": "mail|contact|write|reach",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|mastercard|amex|credit|payment|karte|tarjeta|carte",
    "phone": "phone|tel|call|fax|mobile|telefon|tel[eé]fono|t[eé]l[eé]phone",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "national_id": "ssn|social security|national id|tax id|passport",
}
AGAINST = "example|version|isbn|order no|serial|sku|build"
BONUS, MALUS, THRESHOLD = 0.25, 0.3, 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid Luhn check digit; empty ones have none."""
    figures = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(
            F.filter(figures, lambda d: d != ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)
            ),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    return (F.length(digits) > 0) & (total % 10 == 0)


def mod97(iban: Column) -> Column:
    """Whether the number, its first four characters moved to the end and letters read as 10 to 35,
    leaves 1 modulo 97."""
    compact = F.regexp_replace(iban, r"\x20", "")
    turned = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
            (a * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return F.length(compact).between(15, 34) & (rest == 1)


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def _confirmer(kind: str):
    return lambda span: _confirmed(kind, span["value"])


_SPANS = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
#: Matches placed at a time; appending one by one would copy the array for each.
CHUNK = 128


def _located(text: Column, kind: str) -> Column:
    """Array of (start, end, value, text before, text after) of all matches, before any check.

    The texts reach to the neighbouring matches.
    """
    pattern = PATTERNS[kind]
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def state(at: Column, spans: Column) -> Column:
        return F.struct(at.alias("at"), spans.alias("spans"))

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        span = F.struct(
            start.alias("start"),
            end.alias("end"),
            x["value"].alias("value"),
            x["gap"].alias("before"),
            x["after"].alias("after"),
        )
        return state(end, F.concat(acc["spans"], F.array(span)))

    def place_all(matches: Column) -> Column:
        none = F.array().cast(_SPANS)
        chunks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int"))
        return F.aggregate(
            chunks,
            state(F.lit(0), none),
            lambda acc, c: let(
                F.aggregate(F.slice(matches, c * CHUNK + 1, CHUNK), state(acc["at"], none), place),
                lambda own: state(own["at"], F.concat(acc["spans"], own["spans"])),
            ),
            lambda acc: acc["spans"],
        )

    def with_gaps(values: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda gaps: placed(gaps, values))

    def placed(gaps: Column, values: Column) -> Column:
        before, after = F.slice(gaps, 1, F.size(values)), F.slice(gaps, 2, F.size(values))
        return let(
            F.arrays_zip(before.alias("gap"), values.alias("value"), after.alias("after")), place_all
        )

    return let(
        values,
        lambda v: F.when(F.size(v) > 0, with_gaps(v)).otherwise(F.array().cast(_SPANS)),
    )


@dataclass(frozen=True)
class Options:
    kinds: tuple[str, ...] = KINDS
    threshold: float = THRESHOLD  # for kinds outside BASE


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii", options: Options = Options()) -> DataFrame:
    """``docs`` with an array of (kind, start, end, score, value), by kind as listed, then start.

    Start and end count code points, the end is exclusive. Null texts count as empty and have an
    empty array. Texts of any length are read whole, equal rows have equal arrays, and an empty table
    gives an empty one. A column named ``out`` is replaced.
    """
    unknown = set(options.kinds) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown kinds: {sorted(unknown)}")
    text = text_of(text_col)
    found = []
    for kind in (k for k in KINDS if k in options.kinds):
        checked = F.filter(_located(text, kind), _confirmer(kind))
        scored = F.transform(checked, _scorer(kind))
        if kind not in BASE:
            scored = F.filter(scored, lambda s: s["score"] >= options.threshold)
        found.append(scored)
    return docs.withColumn(out, F.concat(*found))


def _scorer(kind: str):
    return lambda span: _scored(kind, span)


def _scored(kind: str, span: Column) -> Column:
    """The span with its kind and score; context is looked at only for confirmed spans."""
    around = F.concat(F.right(span["before"], F.lit(NEAR)), F.lit(" "), F.left(span["after"], F.lit(NEAR)))
    score = (
        F.lit(PRIOR[kind])
        + F.when(around.rlike(rf"(?i)\b(?:{SUPPORT[kind]})"), BONUS).otherwise(0.0)
        - F.when(around.rlike(rf"(?i)\b(?:{AGAINST})"), MALUS).otherwise(0.0)
    )
    return F.struct(
        F.lit(kind).alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"),
        span["value"].alias("value"),
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, text_col: str = "text", pii: str = "pii", out: str = "text") -> DataFrame:
    """Replace every span found by its kind in angle brackets; overlapping ones become one.

    The spans are walked in the order of their starts. Null texts become empty.
    """
    text = text_of(text_col)
    ordered = F.array_sort(
        F.transform(F.col(f"`{pii}`"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    walked = F.aggregate(
        ordered,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(
                F.when(s["start"] < acc["at"], acc["text"])
                .otherwise(
                    F.concat(
                        acc["text"],
                        F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                        F.lit("<"),
                        s["kind"],
                        F.lit(">"),
                    )
                )
                .alias("text"),
                s["end"].alias("at"),
            )
        ),
    )
    return docs.withColumn(out, F.concat(walked["text"], F.substring(text, walked["at"] + 1, F.length(text))))
