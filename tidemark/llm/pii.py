"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust a score.

Everything is built-in functions on one row, without a shuffle. A kind's expression is run as a
splitter: the pieces between its matches and the matches themselves, in turn, give every span's
place in code points. All quantifiers are possessive and a match may only begin where a run of
its first class begins (or where the last match ended), so a long run costs its length once and
no repetition recurses.

A span's score is its kind's base, plus what a confirming checksum adds, plus what a context word
within ``NEAR`` code points before it adds. It is reported from ``THRESHOLD`` on. The base kinds
(email, ip, card, phone) start there, so context only raises them; ``iban`` needs its mod-97
remainder, ``ssn`` needs a context word. An IBAN ends where its country's length says, whatever
follows after a space; codes of countries without a known length run on as far as they can. Every
place where one can begin is tried, so a beginning that fails hides none after it.

Nulls: a null text is empty and has no spans. Repeated rows are judged each. Only the id and text
columns are read; other columns are not touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 40
THRESHOLD = 0.5

# The expressions of the kinds, the words that speak for one.
BYTE = "(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]?+)|0++)"

#: Characters of an IBAN by country: the registry's, then those in use outside it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST" " CV GW MZ", 26: "IS TR" " DZ IR",
    27: "BI DJ FR GR IT MC MR SM" " CF CG CM GA GQ KM MG TD",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV" " BF BJ CI MA ML NE SN TG", 29: "BR EG PS QA UA" " AO",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_START = "[A-Z]{2}[0-9]{2}"
IBAN_CODE = "|".join(
    [f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?+[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()]
    + [f"(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())}){IBAN_START}(?: ?+[A-Z0-9]){{11,30}}+"]
)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: str
    """A cheap expression that every text with a match meets."""
    base: float
    words: str
    ahead: int = 0
    """If not 0, a match is so many code points long, and what it stands for is its first group."""


EMAIL = Kind(
    "email",
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "@", 0.6, "e-?mail|contact|write to|reply",
)
IP = Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+", ".", 0.5, "ip|host|server|address")
CARD = Kind("card", r"[0-9](?:[ -]?+[0-9])++", "", 0.5, "card|visa|mastercard|credit|debit")
PHONE = Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.5, "phone|call|tel|mobile|fax")
IBAN = Kind(
    "iban", rf"(?={IBAN_START})(?<![A-Za-z0-9])(?=((?:{IBAN_CODE})(?![A-Za-z0-9]))){IBAN_START}", "",
    0.2, "iban|account|bank|transfer", ahead=4,
)
SSN = Kind(
    "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, "ssn|social security",
)
KINDS = (EMAIL, IP, CARD, PHONE, IBAN, SSN)
BASE = ("email", "ip", "card", "phone")
CHECKSUM, CONTEXT = 0.4, 0.3
RUN = 256


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    signs = F.split(F.reverse(digits), "")
    parts = F.transform(
        signs,
        lambda c, i: F.when(i % 2 == 0, c.cast("int"))
        .when(c.cast("int") > 4, c.cast("int") * 2 - 9)
        .otherwise(c.cast("int") * 2),
    )
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code of letters and digits leaves 1 by modulus 97, first four moved last."""
    moved = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))
    return F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
            (a * 100 + F.ascii(c) - 55) % 97
        ),
    ) == 1


def _valid(kind: Kind, found: Column) -> Column:
    """Whether a match stands; checksums are the validators of ``card`` and ``iban``."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind is IP:
        return found.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind is CARD:
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind is PHONE:
        return F.length(digits).between(8, 15)
    if kind is IBAN:
        code = F.replace(found, F.lit(" "), F.lit(""))
        return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(False)
    return F.lit(True)


SPANS = "array<struct<kind:string,first:int,last:int,score:double>>"


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def kind_spans(text: Column, kind: Kind) -> Column:
    """The spans of one kind in a text that is not null.

    Matches are gone through in runs of ``RUN``, so the time grows with their number and no list is
    copied for each of them.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.ahead else 0))
    state = "struct<at:int,end:int,out:" + SPANS + ">"
    none = F.array().cast(SPANS)

    def step(acc: Column, pair: Column) -> Column:
        piece, hit = pair["piece"], pair["hit"]
        first = acc["at"] + F.length(piece)
        last = first + F.length(hit)
        near = F.concat(F.coalesce(pair["before"], F.lit("")), F.lit(" "), piece)
        near = F.lower(F.right(near, F.lit(NEAR)))
        score = F.lit(kind.base)
        if kind in (CARD, IBAN):
            score = score + CHECKSUM
        score = score + F.when(near.rlike(rf"(?:^|[^a-z])(?:{kind.words})(?:[^a-z]|$)"), CONTEXT).otherwise(0.0)
        span = F.struct(
            F.lit(kind.name).alias("kind"), first.alias("first"), last.alias("last"),
            F.least(score, F.lit(1.0)).alias("score"),
        )
        stands = _valid(kind, hit) & (score >= THRESHOLD)
        if kind.ahead:  # not within the span before
            stands &= first >= acc["end"]
        at = first + kind.ahead if kind.ahead else last
        return F.when(stands, F.struct(at.alias("at"), last.alias("end"), F.concat(acc["out"], F.array(span)).alias("out"))).otherwise(
            F.struct(at.alias("at"), acc["end"].alias("end"), acc["out"].alias("out"))
        )

    def run(pairs: Column, acc: Column, number: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), acc["end"].alias("end"), none.alias("out")).cast(state)
        done = F.aggregate(F.slice(pairs, number * RUN + 1, F.lit(RUN)), start, step)
        return bound(done, lambda r: F.struct(r["at"].alias("at"), r["end"].alias("end"), F.concat(acc["out"], r["out"]).alias("out")))

    def gathered(pairs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("end"), none.alias("out")).cast(state)
        runs = F.sequence(F.lit(0), F.floor(F.size(pairs) / RUN).cast("int"))
        return F.aggregate(runs, start, lambda acc, number: run(pairs, acc, number))["out"]

    def paired(hits: Column) -> Column:
        """(piece before a match, match, match before): what follows the last match is left out."""
        before = F.concat(F.array(F.lit(None).cast("string")), hits)
        zipped = F.arrays_zip(F.split(text, kind.pattern, -1), hits, before).cast(
            "array<struct<piece:string,hit:string,before:string>>"
        )
        return F.slice(zipped, 1, F.size(hits))

    spans = bound(bound(found, paired), gathered)
    gate = F.contains(text, F.lit(kind.gate)) if kind.gate else F.lit(True)
    return F.when(gate & text.rlike(kind.pattern), spans).otherwise(none)


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): every reported span of each text, by kind as in ``KINDS``, then by start."""
    whole = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return whole.select(
        "doc_id", F.concat(*[kind_spans(F.col("text"), kind) for kind in KINDS]).alias("spans")
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["last"].cast("string"))
        ),
        ",",
    )


def redact(docs: DataFrame) -> DataFrame:
    """(doc_id, text): each text with its reported spans replaced by their kind in brackets.

    Overlapping spans are replaced once, by the earliest (then longest) of them.
    """
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "spans", F.concat(*[kind_spans(F.col("text"), kind) for kind in KINDS])
    )
    state = "struct<at:int,out:string>"
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["first"].alias("first"), (-s["last"]).alias("back"), s["kind"].alias("kind")))
    )
    done = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(state),
        lambda a, s: F.when(
            s["first"] >= a["at"],
            F.struct(
                (-s["back"]).alias("at"),
                F.concat(
                    a["out"],
                    F.substring(F.col("text"), a["at"] + 1, s["first"] - a["at"]),
                    F.lit("["), s["kind"], F.lit("]"),
                ).alias("out"),
            ),
        ).otherwise(a),
    )
    return found.withColumn("_done", done).select(
        "doc_id",
        F.concat("_done.out", F.expr("substring(text, _done.at + 1)")).alias("text"),
    )
