"""Personal data: broad generators propose spans, boosted trees and calibrated thresholds choose.

Rule-checked spans (email, ip, card, phone) always stay.  Generators with high
recall propose further, overlapping spans; gradient-boosted trees judge them by
format and context, learning from the proposals that the rules confirm or refute
and judging those on which the rules are silent; a threshold
per kind, set on rows the trees did not see, decides which are added.  Texts are
worked on by SQL functions, spans and their features are small rows.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import stage
from netpulse.session import ensure_checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
# Trees, their depth, least bins of a feature; least precision a threshold must reach on unseen rows.
TREES, DEPTH, BINS = 20, 4, 32
LEAST_PRECISION = 0.98
THRESHOLDS = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95)

_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# The rules' leftmost matches, written so that no stretch of text is scanned from each of its characters:
# a start is tried only where a run begins or where the match before ended.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++(?:\.[{_LABEL}]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OUTER = r"\s@<>()\[\],;:\"'"
PROPOSED = {
    "email": rf"(?<![^{_OUTER}])[^{_OUTER}]++(?:@|\x20?[\[(]\x20?(?i:at)\x20?[\])]\x20?)[^{_OUTER}]++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[.,][0-9]{1,3}+){3}(?![0-9])",
    "number": r"(?<![0-9+])\+?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,}+",
}
_CONTEXT = {
    "mail_words": "mail|contact|write", "ip_words": r"\bip\b|host|server|addr", "card_words": "card|visa|credit|pay", "phone_words": "phone|tel|call|mobil|fax",
    "secret_words": "key|token|secret|pass|id",
}
FEATURES = (
    "kind", "chars", "digits", "groups", "longest_group", "dots", "hyphens", "blanks", "brackets", "has_plus", "has_at", "letters", "valid_parts",
    "luhn", "glued_before", "glued_after", *_CONTEXT,
)


def located(text: Column, pattern: str) -> Column:
    """The pattern's leftmost matches as an array of (start, end, value), in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(found, between, lambda m, g: F.struct(m.alias("m"), F.length(g).alias("gap")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(state: Column, pair: Column) -> Column:
        at = state["at"] + pair["gap"]
        end = at + F.length(pair["m"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(at.alias("start"), end.alias("end"), pair["m"].alias("value")))).alias("out"))

    return F.aggregate(pairs, start, step, lambda state: state["out"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of 1 to 30 digits passes the check sum."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        doubled = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    short = F.when(F.length(digits).between(1, 30), F.sequence(F.lit(1), F.length(digits)))
    return F.coalesce(F.aggregate(short, F.lit(0), add) % 10 == 0, F.lit(False))


def _valid(kind: str, value: Column) -> Column:
    digits = F.length(digits_of(value))
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{part}(?:\.{part}){{3}}$"),
        "card": digits.between(13, 19) & luhn(digits_of(value)),
        "phone": digits.between(9, 15),
    }[kind]


def _placed(number: int, kind: str):
    return lambda span: F.struct(F.lit(number).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), _valid(kind, span["value"]).alias("valid"))


def _of_kind(kind: int):
    return lambda span: span["kind"] == kind


def _base_spans(text: Column) -> Column:
    """The rules' matches of all kinds as (kind, start, end, valid); texts without a needed sign skip the scan."""
    needed = {"email": "@", "ip": ".", "card": "0123456789", "phone": "+"}
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    parts = []
    for k, kind in enumerate(KINDS):
        present = F.col("has_digit") if kind == "card" else F.contains(text, F.lit(needed[kind])) & (F.lit(True) if kind == "email" else F.col("has_digit"))
        parts.append(F.transform(F.when(present, located(text, BASE[kind])).otherwise(empty), _placed(k, kind)))
    return F.concat(*parts)


def _proposals(text: Column, matches: Column) -> Column:
    """Proposed spans with their features, and what the rules say of each.

    ``confirmed`` is true where a confirmed span overlaps, false where only a match
    that failed its check does or where the span is part of a longer identifier,
    and null where the rules are silent.
    """

    def features(name: str):
        return lambda span: described(span, name)

    def described(s: Column, name: str) -> Column:
        value, start, end = s["value"], s["start"], s["end"]
        digits = digits_of(value)
        n_digits = F.length(digits)

        def count(signs: str) -> Column:
            return F.length(value) - F.length(F.regexp_replace(value, signs, ""))

        groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
        before = F.lower(F.substring(text, F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24))))
        after = F.substring(text, end + 1, F.lit(1))
        kinds = {"email": F.lit(0), "ip": F.lit(1), "number": F.when(n_digits.between(13, 19), 2).otherwise(3)}
        small = value.rlike(r"^[0-9]{1,3}(?:[.,][0-9]{1,3}){3}$") & F.forall(groups, lambda g: (F.length(g) <= 3) & (F.coalesce(g.try_cast("int"), F.lit(999)) <= 255))
        met = F.filter(matches, lambda b: (b["start"] < end) & (start < b["end"]))
        glued = before.rlike("[A-Za-z0-9_=]$") | after.rlike("[A-Za-z0-9_=]")
        confirmed = F.when(F.exists(met, lambda b: b["valid"]), True).when((F.size(met) > 0) | glued, False)
        own = {
            "kind": kinds[name], "chars": F.length(value), "digits": n_digits, "groups": F.size(groups),
            "longest_group": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)), "dots": count("[.]"), "hyphens": count("-"),
            "blanks": count("[ ]"), "brackets": count(r"[\[\]()]"), "has_plus": value.startswith("+"), "has_at": F.contains(value, F.lit("@")),
            "letters": count("[A-Za-z]"), "valid_parts": small, "luhn": luhn(digits), "glued_before": before.rlike("[A-Za-z0-9_=]$"),
            "glued_after": after.rlike("[A-Za-z0-9_=]"), **{c: before.rlike(words) for c, words in _CONTEXT.items()},
        }
        return F.struct(start.alias("start"), end.alias("end"), confirmed.alias("confirmed"), *[own[f].cast("double").alias(f) for f in FEATURES])

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    parts = []
    for name, pattern in PROPOSED.items():
        present = (F.contains(text, F.lit("@")) | text.rlike(r"(?i)[\[(] ?at ?[\])]")) if name == "email" else F.col("has_digit")
        parts.append(F.transform(F.when(present, located(text, pattern)).otherwise(empty), features(name)))
    return F.concat(*parts)


def _described(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, base spans and proposals per row, written once; no text is kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("has_digit", F.col("text").rlike("[0-9]")).withColumn("matches", _base_spans(F.col("text")))
    base = F.transform(F.filter("matches", lambda b: b["valid"]), lambda b: F.struct(b["kind"], b["start"], b["end"]))
    return stage(rows.select("row_id", "doc_id", base.alias("base"), _proposals(F.col("text"), F.col("matches")).alias("proposals")), "personal")


def fit(proposals: DataFrame) -> tuple[GBTClassificationModel, dict[int, float]] | None:
    """Trees and a threshold per kind from all proposals that the rules confirm or refute.

    Proposals with the same features and outcome become one weighted row.  Every fifth proposal, by
    a hash of its features and place, is kept from the trees and sets the thresholds; a kind for which
    no threshold reaches ``LEAST_PRECISION`` there, or with no such row, adds nothing.  MLlib looks for
    split candidates in a sample of bins ** 2 rows: the bins are so many that this is all of them.
    None if the rows are all of one class.
    """
    ensure_checkpoint_dir(proposals.sparkSession)
    held = F.pmod(F.xxhash64("doc_id", "start", "end", *FEATURES), F.lit(5)) == 0
    names = [*FEATURES, "label", "held"]
    rows = proposals.where("confirmed IS NOT NULL").select(*FEATURES, F.col("confirmed").cast("double").alias("label"), held.alias("held"))
    rows = rows.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("weight")).orderBy(*names)
    rows = stage(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows), "fit")
    train, held = rows.where("NOT held"), rows.where("held")
    low, high, distinct = train.agg(F.min("label"), F.max("label"), F.count(F.lit(1))).first()
    if low is None or low == high:
        return None
    bins = max(BINS, math.isqrt(distinct) + 1)
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, maxBins=bins, stepSize=0.2, seed=1, checkpointInterval=10, featuresCol="features", labelCol="label", weightCol="weight",
    ).fit(train.select("features", "label", "weight"))
    judged = trees.transform(held).select("kind", "label", "weight", vector_to_array("probability")[1].alias("p"))
    grid = judged.withColumn("t", F.explode(F.array(*[F.lit(t) for t in THRESHOLDS]))).where("p >= t")
    precision = F.sum(F.col("label") * F.col("weight")) / F.sum("weight")
    good = grid.groupBy("kind", "t").agg(precision.alias("precision")).where(F.col("precision") >= LEAST_PRECISION)
    return trees, {int(r["kind"]): r["t"] for r in good.groupBy("kind").agg(F.min("t").alias("t")).collect()}


def find_personal(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and the digest are of the confirmed spans; ``spans`` also holds the
    added ones, which never overlap a confirmed or another added span.  Null counts
    as empty; texts without spans give zero counts, the digest of the empty string
    and empty spans.  Repeated rows and missing ids are rows of their own.
    """
    rows = _described(docs)
    proposals = rows.select("row_id", "doc_id", F.explode("proposals").alias("p")).select("row_id", "doc_id", "p.*")
    model = fit(proposals)
    span = "array<struct<kind:int,start:int,end:int>>"
    if model is None or not model[1]:
        chosen = rows.select("row_id", F.array().cast(span).alias("added")).where("false")
    else:
        trees, limits = model
        open_rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(proposals.where("confirmed IS NULL"))
        judged = trees.transform(open_rows).select("row_id", F.col("kind").cast("int").alias("kind"), "start", "end", vector_to_array("probability")[1].alias("p"))
        least = F.create_map(*[F.lit(x) for k, t in sorted(limits.items()) for x in (k, t)])
        passed = judged.where(F.col("p") >= F.coalesce(F.try_element_at(least, F.col("kind")), F.lit(2.0)))
        listed = passed.groupBy("row_id").agg(F.collect_list(F.struct((-F.col("p")).alias("loss"), "start", "end", "kind")).alias("all"))

        def rank(s: Column) -> Column:
            return F.struct(s["loss"], s["start"], s["end"], s["kind"])

        free = F.filter("all", lambda s: ~F.exists("all", lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]) & (rank(o) < rank(s))))
        chosen = listed.select("row_id", F.transform(free, lambda s: F.struct(s["kind"], s["start"], s["end"])).cast(span).alias("added"))
    joined = rows.select("row_id", "doc_id", "base").join(chosen, "row_id", "left").withColumn("added", F.coalesce("added", F.array().cast(span)))
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return joined.select(
        "doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def redacted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id and text with every span of ``found`` (doc_id, spans) replaced by its kind in angle brackets; ids must be unique."""
    parsed = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    places = F.array_sort(F.transform(parsed, lambda p: F.struct(F.get(p, 1).cast("int").alias("start"), F.get(p, 2).cast("int").alias("end"), F.get(p, 0).alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        kept = F.substring(F.col("text"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        mark = F.when(s["start"] >= state["at"], F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], kept, mark).alias("out"))

    text = F.coalesce(F.col("text"), F.lit(""))
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(found.select("doc_id", places.alias("places")), "doc_id")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate("places", start, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    return joined.select("doc_id", whole.alias("text"))
