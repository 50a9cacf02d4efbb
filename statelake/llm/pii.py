"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

A text is cut at each match of a pattern; gaps and matches become rows, and running sums of their
lengths give the spans. Every match gets points: those of its kind, more if a checksum confirms it
(Luhn for cards, modulo 97 for account numbers), more or less if a word that goes with the kind, or one
that speaks against it, stands nearby. Nearby means within ``window`` characters, up to the next match
of the same pattern. Spans of the fixed kinds (email, ip, card, phone) stay once their own test holds,
whatever their points; spans of the added kinds (iban, ssn, shortcard, localphone) are reported when
they reach ``threshold`` points, stand apart from letters and digits, and do not start inside a fixed
span.

Defined cases: a NULL or empty text has no spans; repeated rows are scanned each for itself; a NULL id
stays NULL; very long texts, also such without any separator, are scanned in linear time, because a
pattern is only tried where a match can begin; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statelake.llm.common import stored

# The patterns as stated; any engine finds the same matches with them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}([A-Z0-9]{11,30}|(\x20[A-Z0-9]{4}){2,7}(\x20[A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "localphone": r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
}
# The same matches where a backtracking matcher would retry every character of a long run or recurse
# for every repetition: runs are taken whole, and a run is entered at its start or after a match.
LINEAR = PATTERNS | {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
}
# What a text must hold for a pattern to be tried at all.
NEEDED = {"email": "@", "phone": "+"}
ORDER = ["email", "ip", "card", "phone", "iban", "ssn", "shortcard", "localphone"]
N_FIXED = 4
# Points of a kind by its form alone, and with its checksum.
POINTS = {"email": 80, "ip": 50, "card": 70, "phone": 60, "iban": 70, "ssn": 20, "shortcard": 40, "localphone": 20}
SUPPORT, CONTRARY = 40, 30
# Words that go with a kind; lower case, between characters that are no letters.
CONTEXT = {
    "email": "email|e-mail|mail|contact|write",
    "ip": "ip|address|host|server|login",
    "card": "card|credit|debit|visa|mastercard|payment|cvv",
    "phone": "phone|call|tel|telephone|mobile|fax|cell",
    "iban": "iban|account|bank|transfer|payment",
    "ssn": "ssn|social|security|taxpayer|identity",
    "shortcard": "card|credit|debit|amex|express|diners|payment|cvv",
    "localphone": "phone|call|tel|telephone|mobile|fax|cell",
}
AGAINST = "example|sample|test|dummy|placeholder|version|isbn|invoice|order"
OCTET = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class PiiRules:
    """``window`` in characters on either side of a match; ``threshold`` in points, of 100."""

    window: int = 40
    threshold: int = 50


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    value = lambda c, i: F.when(i % 2 == 0, c).otherwise(F.translate(c, "0123456789", "0246813579")).cast("int")
    return F.aggregate(F.transform(each, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number without blanks leaves 1 modulo 97."""
    turned = F.concat(F.substr(code, F.lit(5)), F.left(code, F.lit(4)))
    each = F.filter(F.split(turned, ""), lambda c: c != "")
    digit = lambda c: c.between("0", "9")
    step = lambda a, c: F.when(digit(c), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(each, F.lit(0), step) == 1


def _nearby(words: str, around: Column) -> Column:
    return around.rlike(f"(^|[^a-z])({words})([^a-z]|$)")


def _points(kind: str, around: Column) -> Column:
    more = F.when(_nearby(CONTEXT[kind], around), F.lit(SUPPORT)).otherwise(F.lit(0))
    less = F.when(_nearby(AGAINST, around), F.lit(CONTRARY)).otherwise(F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(100), F.lit(POINTS[kind]) + more - less))


def _judged(name: str, match: Column, before: Column, after: Column, rules: PiiRules) -> Column:
    """(kind, points) of a match of pattern ``name``, or NULL if it fails."""
    around = F.lower(F.concat(before, F.lit(" "), after))

    def kept(kind: str) -> Column:
        return F.struct(F.lit(ORDER.index(kind)).alias("kind"), _points(kind, around).alias("points"))

    def added(kind: str) -> Column:
        apart = ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]")
        return F.when(apart & (_points(kind, around) >= rules.threshold), kept(kind))

    digits = F.regexp_replace(match, "[^0-9]", "")
    if name == "email":
        return kept("email")
    if name == "ip":
        return F.when(match.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$"), kept("ip"))
    if name == "card":
        n = F.char_length(digits)
        return F.when(n.between(16, 19) & luhn(digits), kept("card")).when(n.between(13, 15) & luhn(digits), added("shortcard"))
    if name == "phone":
        return F.when(F.char_length(digits).between(8, 15), kept("phone"))
    if name == "iban":
        code = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.char_length(code).between(15, 34) & mod97(code), added("iban"))
    return added(name)


def _pieces(text: Column, name: str, rules: PiiRules) -> Column:
    """Matches of one pattern in text order: the gap before each, its length, kind and points."""
    pattern = LINEAR[name]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<pattern:int,turn:int,gap:int,length:int,judged:struct<kind:int,points:int>>>")

    def rows(found: Column, gaps: Column) -> Column:
        zipped = F.arrays_zip(
            F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found"), F.slice(gaps, 2, F.size(found)).alias("next")
        )
        return F.transform(
            zipped,
            lambda x, i: F.struct(
                F.lit(list(PATTERNS).index(name)).alias("pattern"), i.alias("turn"),
                F.char_length(x["gap"]).alias("gap"), F.char_length(x["found"]).alias("length"),
                _judged(name, x["found"], F.right(x["gap"], F.lit(rules.window)), F.left(x["next"], F.lit(rules.window)), rules).alias("judged"),
            ),
        )

    # an array of one, transformed, holds both lists, so that neither is found twice
    both = F.array(F.struct(matches.alias("found"), F.split(text, pattern).alias("gaps")))
    tried = text.rlike(pattern)
    if name in NEEDED:
        tried = F.contains(text, F.lit(NEEDED[name])) & tried
    return F.when(tried, F.transform(both, lambda b: rows(b["found"], b["gaps"]))[0]).otherwise(empty)


def scanned(docs: DataFrame, carry: list[str], rules: PiiRules, text: str = "text") -> DataFrame:
    """All rows of ``docs``, numbered, with their matches; written once."""
    t = F.coalesce(F.col(text), F.lit(""))
    hits = F.concat(*[_pieces(t, name, rules) for name in PATTERNS])
    return stored(docs.select(F.monotonically_increasing_id().alias("__row"), *carry, hits.alias("__hits")), "pii-hits")


def spans_of(scan: DataFrame) -> DataFrame:
    """``scan`` with ``spans``: structs of kind, start, end and points, sorted in this order.

    Only matches move, once, by the row they are of; rows without any stay where they are.
    """
    carried = [c for c in scan.columns if c != "__hits"]
    in_turn = Window.partitionBy("__row", "pattern").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        scan.filter(F.size("__hits") > 0)
        .select(*carried, F.explode("__hits").alias("__hit"))
        .select(F.struct(*carried).alias("__doc"), "__row", "__hit.*")
        .repartition("__row")
        .withColumn("end", F.sum(F.col("gap") + F.col("length")).over(in_turn))
        .withColumn("start", F.col("end") - F.col("length"))
    )
    fixed = F.coalesce(F.col("judged.kind") < N_FIXED, F.lit(False))
    by_start = Window.partitionBy("__row").orderBy("start", "pattern").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.when(fixed, F.col("end"))).over(by_start), F.lit(0))
    span = F.struct(F.col("judged.kind").alias("kind"), "start", "end", F.col("judged.points").alias("points"))
    reported = F.when(F.col("judged").isNotNull() & (fixed | (F.col("reached") <= F.col("start"))), span)
    found = placed.withColumn("reached", reached).groupBy("__row").agg(
        F.any_value("__doc").alias("__doc"), F.array_sort(F.collect_list(reported)).alias("spans")
    )
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,points:int>>")
    clean = scan.filter(F.size("__hits") == 0).select(*carried, none.alias("spans"))
    return clean.unionByName(found.select("__doc.*", "spans")).drop("__row")


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ORDER])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def personal_data(docs: DataFrame, rules: PiiRules = PiiRules(), text: str = "text") -> DataFrame:
    """One row per document: counts of the fixed kinds, a digest of their spans, all spans as text and
    as structs with points (``found``), the number of added ones and the highest points."""
    held = spans_of(scanned(docs, ["doc_id"], rules, text))
    fixed = F.filter("spans", lambda s: s["kind"] < N_FIXED)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == ORDER.index(kind))).cast("long").alias(f"n_{kind}")
    return held.select(
        "doc_id",
        *[count(kind) for kind in ORDER[:N_FIXED]],
        F.sha2(_text_of(fixed), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(fixed)).cast("long").alias("n_added"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["points"])), F.lit(0)).cast("long").alias("top_points"),
        F.col("spans").alias("found"),
    )
