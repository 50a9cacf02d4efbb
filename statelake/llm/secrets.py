"""Secret scans with corpus-wide ownership of every candidate.

A text is cut at each match of a pattern; gaps and matches become rows, and running sums of their
lengths give the spans. The hash of each candidate's value is then counted over distinct repositories
and owners. A value that one owner alone holds, in few repositories, looks live; one that several owners
hold, or one owner all over its repositories, is an example that was copied around. The fixed kinds are always reported; strings of the ``generic`` kind (long,
mixed letters and digits, outside the fixed spans) are added only when they look live.

Defined cases: a NULL or empty text has no spans; repeated rows are scanned each for itself and count
as one repository; a NULL owner or repository is one of its own; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statelake.llm.common import source_key, stored

# Kinds in their order, with their pattern and the group that holds the value.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2),
    "access": (r"AKIA[A-Z0-9]{14,}", 0),
    "hex": (r"[0-9a-f]{16,}", 0),
    "generic": (r"[A-Za-z0-9+/_-]{20,}", 0),
}
ORDER = list(KINDS)
REDACTED = "[SECRET]"


@dataclass(frozen=True)
class SecretRules:
    """``max_owners`` and ``max_repositories`` are the largest numbers of owners and of repositories that a
    live-looking value may have."""

    min_assigned: int = 12
    max_owners: int = 1
    max_repositories: int = 10


def _pieces(text: Column, kind: str) -> Column:
    """Matches of one kind in text order, each with the gap before it."""
    pattern, group = KINDS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    gaps = F.transform(F.split(text, pattern), lambda x: F.char_length(x))

    def rows(found: Column) -> Column:
        zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found"), values.alias("value"))
        return F.transform(
            zipped,
            lambda x, i: F.struct(
                F.lit(ORDER.index(kind)).alias("kind"), i.alias("turn"), x["gap"].alias("gap"),
                F.char_length(x["found"]).alias("length"), x["value"].alias("value"),
            ),
        )

    empty = F.array().cast("array<struct<kind:int,turn:int,gap:int,length:int,value:string>>")
    found = F.transform(F.array(matches), lambda m: F.when(F.size(m) > 0, rows(m)).otherwise(empty))
    return found[0]


def scanned(docs: DataFrame, carry: list[str], text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """All rows of ``docs``, numbered, with their raw matches; written once."""
    t = F.coalesce(F.col(text), F.lit(""))
    hits = F.concat(*[_pieces(t, kind) for kind in ORDER])
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("__row"), *carry,
            source_key(F.col(owner)).alias("__owner"), source_key(F.col(repository)).alias("__repository"), hits.alias("__hits"),
        ),
        "secret-hits",
    )


def candidates(scan: DataFrame, rules: SecretRules) -> DataFrame:
    """One row per candidate: row number, kind, start, end and the hash of its value."""
    in_turn = Window.partitionBy("__row", "kind").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        scan.filter(F.size("__hits") > 0)
        .select("__row", "__owner", "__repository", F.explode("__hits").alias("hit"))
        .select("__row", "__owner", "__repository", "hit.*")
        .withColumn("end", F.sum(F.col("gap") + F.col("length")).over(in_turn))
        .withColumn("start", F.col("end") - F.col("length"))
    )
    assigned = (F.col("kind") != ORDER.index("assign")) | (F.char_length("value") >= rules.min_assigned)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]") & ~F.col("value").rlike("[0-9a-f]{16}|AKIA[A-Z0-9]{14}")
    fixed = F.col("kind") < ORDER.index("generic")
    kept = spans.filter(assigned & (fixed | mixed))
    by_start = Window.partitionBy("__row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.when(fixed, F.col("end"))).over(by_start), F.lit(0))
    apart = kept.withColumn("reached", reached).filter(fixed | (F.col("reached") <= F.col("start")))
    return apart.select("__row", "__owner", "__repository", "kind", "start", "end", F.sha2("value", 256).alias("hash"))


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every candidate hash.

    Distinct (hash, owner, repository) come first, so a value that a third of all documents hold is
    spread over many tasks until only its counts are left.
    """
    holders = found.select("hash", "__owner", "__repository").distinct()
    owned = holders.groupBy("hash", "__owner").agg(F.count("*").alias("held"))
    return owned.groupBy("hash").agg(F.sum("held").alias("n_repositories"), F.count("*").alias("n_owners"))


def spans_of(scan: DataFrame, rules: SecretRules) -> DataFrame:
    """``scan`` with ``spans`` (sorted structs of start, kind, end), ``n_live`` and ``n_shared``."""
    found = stored(candidates(scan, rules), "secret-candidates")
    few = (F.col("n_owners") <= rules.max_owners) & (F.col("n_repositories") <= rules.max_repositories)
    judged = found.join(ownership(found), "hash").withColumn("live", few)
    reported = judged.filter((F.col("kind") < ORDER.index("generic")) | F.col("live"))
    per_row = reported.groupBy("__row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_shared"),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return (
        scan.drop("__hits", "__owner", "__repository")
        .join(per_row, "__row", "left")
        .withColumn("spans", F.coalesce("spans", none))
        .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_live", "n_shared")})
    )


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ORDER])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def secrets(docs: DataFrame, rules: SecretRules = SecretRules(), text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per document: counts of the fixed kinds, a digest of their spans, and all spans."""
    held = spans_of(scanned(docs, ["doc_id"], text, owner, repository), rules)
    fixed = F.filter("spans", lambda s: s["kind"] < ORDER.index("generic"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == ORDER.index(kind))).cast("long")
    return held.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_text_of(fixed), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
        "n_live",
        "n_shared",
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by a marker; overlapping spans become one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        between = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(fresh, F.concat(acc["out"], between, F.lit(REDACTED))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text)))
    return F.aggregate(spans, start, step, rest)


def redact(docs: DataFrame, rules: SecretRules = SecretRules(), text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``docs`` with all found spans taken out of ``text``; only rows that have matches move.

    Rows travel as one struct, so no column of theirs can clash with the operator's.
    """
    packed = docs.select(F.struct(*docs.columns).alias("__doc"), text, *{owner, repository} - {text})
    scan = scanned(packed, ["__doc"], text, owner, repository)
    clean = scan.filter(F.size("__hits") == 0).select("__doc")
    hit = spans_of(scan.filter(F.size("__hits") > 0), rules)
    old = F.col("__doc")[text]
    cut = F.when(F.size("spans") > 0, redacted(old, F.col("spans"))).otherwise(old)
    return clean.unionByName(hit.select(F.col("__doc").withField(text, cut).alias("__doc"))).select("__doc.*")
