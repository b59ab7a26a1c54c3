r"""Personal data by pattern, checksum and context (DataFrame operations only).

Regular expressions propose spans, validators confirm them, context words near
a span adjust its score.

* Base kinds email, ip, card, phone follow fixed definitions.  The patterns are
  written so that a search is linear in the text: runs are matched possessively
  and an attempt starts only where a run starts (or where the last match
  ended), which yields the same leftmost non-overlapping matches as the plain
  patterns without rescanning a long run, or recursing, at every character.
* Added kinds: ``iban`` (country, two check digits, as many characters as the
  country's IBANs have, mod-97 = 1; other countries the longest run) and ``card13``
  (13 digits passing Luhn, kept only if its score reaches ``keep_at``; so does
  ``ssn``, three-two-four digits, which has no checksum and lives on context).
* Score: a prior by kind, plus ``CONTEXT_BONUS`` if one of the kind's words is
  within ``CONTEXT_CHARS`` characters before or after the span (as far as the
  kind's next match), minus ``CONTEXT_MALUS`` if a word that speaks against it is.

Positions come from the texts between matches: split by the pattern, add up the
lengths.  A pattern runs only on texts that hold its trigger.
Offsets count code points, the end is exclusive.

Defined cases: a null text is an empty one; an empty text has no spans and the
hash of the empty string; repeated rows give repeated results; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import LOWER, UPPER, table

# countries by the characters of their IBANs, those that use them without a registry entry included
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FO FK GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA MG ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_LISTED = "|".join(c for countries in IBAN_COUNTRIES.values() for c in countries.split())
_IBAN = "(?:" + "|".join(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}"
                         for n, countries in IBAN_COUNTRIES.items()) + ")(?![A-Za-z0-9])"
# kind -> (trigger, pattern); \G lets a match start where the last one ended
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": ("@", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (".", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": ("", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    # four characters before what has the form of an IBAN itself are none's start; a run without a known length ends there
    "iban": ("", rf"(?<![A-Za-z0-9])(?![A-Z]{{2}}[0-9]{{2}}\x20{_IBAN})(?:{_IBAN}|(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}"
                 rf"(?:(?:\x20(?!{_IBAN}))?[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))"),
    "card13": ("", r"(?<![0-9-])[0-9](?:[\x20-]?[0-9]){12}(?![\x20-]?[0-9])"),
    "ssn": ("-", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
#: Where no single character triggers a kind.
GUARD = {"card": "[0-9][0-9\\x20-]{11}", "card13": "[0-9][0-9\\x20-]{11}", "iban": "[A-Z]{2}[0-9]{2}"}
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.8, "iban": 0.95, "card13": 0.4, "ssn": 0.3}
CONTEXT = {
    "email": "mail|contact|write", "ip": "ip|address|host|server|login", "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile|fax", "iban": "iban|bank|account|konto|compte|cuenta",
    "card13": "card|visa|credit|payment", "ssn": "ssn|social|security|taxpayer",
}
AGAINST = {
    "email": "example", "ip": "version|release", "card": "isbn|order|serial", "phone": "isbn|version",
    "iban": "serial", "card13": "isbn|order|serial", "ssn": "part|serial|version",
}
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.1
CONTEXT_MALUS = 0.1
KEEP_AT = 0.5
RUN = 256  # matches placed together


def _luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes Luhn's check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces leaves 1 modulo 97 (letters are 10 to 35)."""
    moved = F.concat(F.substring(iban, 5, 1 << 20), F.substring(iban, 1, 4))
    numbers = F.transform(F.split(moved, ""), lambda c: F.instr(F.lit("0123456789" + UPPER), c) - 1)
    return F.aggregate(F.filter(numbers, lambda d: d >= 0), F.lit(0),
                       lambda a, d: F.when(d > 9, a * 100 + d).otherwise(a * 10 + d) % 97) == 1


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")) <= 3) & F.forall(
            F.split(found, r"\."), lambda p: F.coalesce(
                F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 4).try_cast("int"), F.lit(256)) <= 255)
    if kind == "card":
        return F.length(digits).between(14, 19) & _luhn(digits)
    if kind == "card13":
        return _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return _mod97(F.regexp_replace(found, " ", ""))
    return F.lit(True)


_PLACED = "array<struct<start:bigint,stop:bigint,found:string,around:string>>"


def _found(kind: str) -> dict[str, Column]:
    """The kind's matches, and the texts before, between and behind them."""
    trigger, pattern = PATTERNS[kind]
    text = F.col("text")
    has = text.contains(trigger) if trigger else text.rlike(GUARD[kind])
    return {f"_{kind}_found": F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(
        F.array().cast("array<string>")),
        f"_{kind}_gaps": F.when(has, F.split(text, pattern, -1)).otherwise(F.array(F.lit("")))}


def _zipped(kind: str) -> Column:
    found, gaps = F.col(f"_{kind}_found"), F.col(f"_{kind}_gaps")
    return F.arrays_zip(found.alias("found"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"),
                        F.slice(gaps, F.lit(2), F.size(found)).alias("after"))


def _length(x: Column) -> Column:
    return (F.length(x["gap"]) + F.length(x["found"])).cast("bigint")


def _runs(kind: str) -> Column:
    """The matches in runs of ``RUN``, so that placing a text's matches stays linear."""
    zipped = F.col(f"_{kind}_zip")
    last = F.greatest(F.floor((F.size(zipped) - 1) / RUN), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(zipped, k * RUN + 1, F.lit(RUN)))


def _ends(kind: str) -> Column:
    return F.transform(F.col(f"_{kind}_runs"), lambda run: F.aggregate(
        run, F.lit(0).cast("bigint"), lambda a, x: a + _length(x)))


def _starts(kind: str) -> Column:
    ends = F.col(f"_{kind}_ends")
    return F.transform(ends, lambda _, k: F.aggregate(
        F.slice(ends, F.lit(1), k), F.lit(0).cast("bigint"), lambda a, e: a + e))


def _placed(kind: str) -> Column:
    def place(run, at):
        # the running end and the spans so far; a run is bounded, so appending stays cheap
        return F.aggregate(
            run, F.struct(at.alias("at"), F.array().cast(_PLACED).alias("spans")),
            lambda acc, x: F.struct(
                (acc["at"] + _length(x)).alias("at"),
                F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + F.length(x["gap"])).alias("start"), (acc["at"] + _length(x)).alias("stop"),
                    x["found"].alias("found"),
                    F.concat_ws(" ", F.right(x["gap"], F.lit(CONTEXT_CHARS)),
                                F.left(x["after"], F.lit(CONTEXT_CHARS))).alias("around")))).alias("spans")),
            lambda acc: acc["spans"])

    return F.flatten(F.zip_with(f"_{kind}_runs", f"_{kind}_starts", place))


def _spans(kind: str, keep_at: float) -> Column:
    """array<struct<start, rank, stop, kind, score>> of the kind's confirmed spans."""
    def scored(s):
        around = F.translate(s["around"], UPPER, LOWER)
        near = F.when(around.rlike(rf"(?<![a-z])(?:{CONTEXT[kind]})"), CONTEXT_BONUS).otherwise(0.0)
        against = F.when(around.rlike(rf"(?<![a-z])(?:{AGAINST[kind]})"), CONTEXT_MALUS).otherwise(0.0)
        # the bonus of a kind without a strong proof weighs more: context is all it has
        weight = 3.0 if kind in ("ssn", "card13") else 1.0
        return F.least(F.greatest(F.lit(PRIOR[kind]) + near * weight - against * weight, F.lit(0.0)), F.lit(1.0))

    spans = F.transform(F.filter(F.col(f"_{kind}_placed"), lambda s: _valid(kind, s["found"])), lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["stop"].alias("stop"),
        F.lit(kind).alias("kind"), scored(s).alias("score")))
    return spans if kind in BASE_KINDS else F.filter(spans, lambda s: s["score"] >= keep_at)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id and spans: array of (start, rank, stop, kind, score), by start, then kind."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # one projection a step: each step's arrays are used more than once by the next, so they are
    # computed once a text and never inside a lambda
    rows = rows.withColumns({c: e for k in KINDS for c, e in _found(k).items()})
    for name, step in (("zip", _zipped), ("runs", _runs), ("ends", _ends), ("starts", _starts), ("placed", _placed)):
        rows = rows.withColumns({f"_{k}_{name}": step(k) for k in KINDS})
    return rows.select("doc_id", F.array_sort(F.concat(*[_spans(k, keep_at) for k in KINDS])).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"),
                        F.coalesce(F.array_max("spans.score"), F.lit(0.0)).alias("max_score"))
