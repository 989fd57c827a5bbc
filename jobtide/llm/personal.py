"""Personal data by candidate gradient boosting, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import packed, with_columns
from jobtide.plans.store import stored

#: Kinds in the order in which spans at one place are listed, and their base patterns. Where a repetition
#: could not match otherwise by giving characters back it is possessive, and a run is only tried from its start, so that
#: long runs take linear time and no stack.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of candidates: kind, pattern, and a text that every match contains (empty: a digit). They overlap.
GENERATORS = (
    ("email", r"[^\s@,;<>()\"']++@[^\s@,;<>()\"']++", "@"),
    ("email", r"[A-Za-z0-9._%+-]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]++)++", "at"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])", ""),
    ("card", r"(?<![0-9])[0-9]{12,19}(?![0-9])", ""),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){2,3}(?![0-9])", ""),
    ("phone", r"(?<![0-9+])\+?(?:[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{4}(?![0-9])", ""),
    ("phone", r"\+?[0-9(][0-9 ().-]{5,}[0-9]", ""),
)
#: Words that announce a kind, looked for in the characters before a candidate.
HINTS = {"email": "mail|contact", "ip": r"\bip\b|host|server|address", "card": "card|visa|credit", "phone": "phone|tel|call|mobile|fax"}
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CONTEXT = 24


def _matches(text: Column, pattern: str) -> Column:
    """All matches from left to right as structs of start, end (code points, end exclusive) and the matched text."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["between"])
        end = begin + F.length(x["match"])
        one = F.struct(begin.alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    pairs = F.filter(F.arrays_zip(between.alias("between"), found.alias("match")), lambda x: x["match"].isNotNull())
    return F.aggregate(pairs, start, step, lambda state: state["out"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.try_to_number(F.substring(F.reverse(digits), i, F.lit(1)), F.lit("9")).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v))
    return F.when(F.length(digits).between(1, 19), total % 10 == 0).otherwise(False)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(match)).between(12, 19) & _luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _quick(text: Column, needle: str) -> Column:
    return F.contains(text, F.lit(needle)) if needle else text.rlike("[0-9]")


def _valid_match(kind: str, x: Column) -> Column:
    return _valid(kind, x["match"])


def _span(kind: str, x: Column) -> Column:
    return F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"))


def _candidate(kind: str, x: Column) -> Column:
    same = lambda y: (y["start"] == x["start"]) & (y["end"] == x["end"])
    is_base = F.exists(f"base_{kind}", same)
    inside = F.exists(f"raw_{kind}", lambda y: (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & ~same(y))
    begin = F.greatest(F.lit(1), x["start"] + 1 - CONTEXT)
    return F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"), x["match"].alias("match"),
        F.substring("text", begin, x["start"] + 1 - begin).alias("before"),
        F.substring("text", x["end"] + 1, F.lit(CONTEXT)).alias("after"),
        F.when(is_base, 1).when(inside, None).otherwise(_other_label(kind, x, F.substring("text", begin, x["start"] + 1 - begin))).alias("label"),
    )


def _other_label(kind: str, x: Column, before: Column) -> Column:
    """Label of a candidate that is no base span. Forms that no base pattern matches are labelled by their normalised form.

    An address with words for its signs is a span if it is an address with the signs. A phone number without a plus is one
    if a word announces it, none if it has too few or many digits, and has no label otherwise.
    """
    if kind == "email":
        signs = F.regexp_replace(F.regexp_replace(x["match"], r" ?[\[(] ?at ?[\])] ?", "@"), r" ?[\[(] ?dot ?[\])] ?", ".")
        address = signs.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")
        return F.when(F.contains(x["match"], F.lit("@")), 0).when(address, 1).otherwise(0)
    if kind == "phone":
        taken = lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])
        other = F.lit(False)
        for name in KINDS:
            other = other | F.exists(f"base_{name}", taken)
        fits = _valid("phone", x["match"]) & ~other
        return F.when(F.startswith(x["match"], F.lit("+")) | ~fits, 0).when(F.lower(before).rlike(HINTS["phone"]), 1)
    return F.lit(0)


def propose(docs: DataFrame) -> DataFrame:
    """Base spans and candidates of each row of ``(rid, id, row, text)``; candidates come with their context and label.

    The label says whether a candidate is a base span or, in a form that no base pattern matches, a span by its normalised
    form; a candidate inside a longer match that failed its check has none.
    """
    text = F.col("text")
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    needles = {"email": "@", "ip": ".", "card": "", "phone": "+"}
    raw = {f"raw_{kind}": F.when(_quick(text, needles[kind]), _matches(text, PATTERNS[kind])).otherwise(none) for kind in KINDS}
    made = {
        f"made_{at}": F.when(_quick(text, needle), _matches(text, pattern)).otherwise(none)
        for at, (_, pattern, needle) in enumerate(GENERATORS)
    }
    found = docs.select("rid", "row", "text", *[c.alias(n) for n, c in (raw | made).items()])
    base = {kind: F.filter(f"raw_{kind}", partial(_valid_match, kind)) for kind in KINDS}
    found = found.select("*", *[column.alias(f"base_{kind}") for kind, column in base.items()])
    spans = F.array_sort(F.flatten(F.array(*[F.transform(f"base_{kind}", partial(_span, kind)) for kind in KINDS])))

    candidates = F.array_distinct(F.flatten(F.array(*[
        F.transform(f"made_{at}", partial(_candidate, kind)) for at, (kind, _, _) in enumerate(GENERATORS)
    ])))
    return found.select("rid", "row", spans.alias("base"), candidates.alias("candidates"))


def _features() -> dict[str, Column]:
    """Format and context of a candidate ``c``."""
    match, before, after = F.col("c.match"), F.col("c.before"), F.col("c.after")
    count = lambda pattern: F.regexp_count(match, F.lit(pattern)).cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    digits = _digits(match)
    return {
        **{f"is_{kind}": flag(F.col("c.kind") == code) for code, kind in enumerate(KINDS)},
        "length": F.length(match).cast("double"), "digits": F.length(digits).cast("double"), "groups": count("[0-9]+"),
        "letters": count("[A-Za-z]"), "separators": count(r"[ .()-]"), "signs": count(r"[^A-Za-z0-9 .()-]"),
        "plus": flag(match.startswith("+")), "checksum": flag(_luhn(digits)),
        "octets": flag(match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")), "domain": flag(match.rlike(r"@.*\.[A-Za-z]{2,}$")),
        "ends_well": flag(match.rlike("[A-Za-z0-9]$")), "after_space": flag((before == "") | before.rlike(r"\s$")),
        "before_space": flag((after == "") | after.rlike(r"^(?:\s|[.,;:!?](?:\s|$))")),
        "after_digit": flag(before.rlike("[0-9]$") | before.rlike(r"[0-9][ .-]$")), "before_digit": flag(after.rlike(r"^[ .-]?[0-9]")),
        "near_digits": F.regexp_count(F.concat(before, after), F.lit("[0-9]")).cast("double"),
        **{f"hint_{kind}": flag(F.lower(before).rlike(hint)) for kind, hint in HINTS.items()},
    }


@dataclass
class SpanModel:
    """Boosted trees and, per kind, the score from which a candidate is a span (None: no candidate of it is)."""

    trees: GBTClassificationModel | None
    thresholds: dict[int, float]


def _assembled(candidates: DataFrame) -> DataFrame:
    features = _features()
    flat = candidates.select("rid", "c", *[column.alias(name) for name, column in features.items()])
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(flat).select("rid", "c", "features")


def _scored(trees: GBTClassificationModel, candidates: DataFrame) -> DataFrame:
    return trees.transform(candidates).withColumn("score", vector_to_array("probability")[1])


def fit_spans(proposed: DataFrame, max_candidates: int = 20_000, precision: float = 0.99, seed: int = 1) -> SpanModel:
    """Learn which candidates are spans from a sample by hash, about *max_candidates* labelled candidates, as many of each kind.

    At most three quarters of a kind fit the trees. All other labelled candidates are scored: a kind's threshold is the
    lowest score, in steps of 0.01 from 0.5 up, from which at least *precision* of them are spans. Without both labels in the
    sample no candidate is added.
    """
    parts = 1 << 20
    order = F.xxhash64(F.lit(seed), "rid", "c.start", "c.kind", "c.end")
    labelled = proposed.select("rid", F.explode("candidates").alias("c")).where("c.label IS NOT NULL")
    sizes = {row["kind"]: row["n"] for row in labelled.groupBy(F.col("c.kind").alias("kind")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return SpanModel(None, {})
    share = {kind: int(parts * min(0.75, max_candidates / len(KINDS) / n)) for kind, n in sizes.items()}
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.col("c.kind"))
    fits = F.pmod(order, parts) < limit
    label = F.col("c.label").cast("double").alias("label")
    sample = stored(_assembled(labelled.where(fits)).select("*", label), "spans-features")
    if sample.agg(F.count_distinct("label").alias("n")).first()["n"] < 2:
        return SpanModel(None, {})
    booster = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=seed, cacheNodeIds=False)
    trees = booster.fit(sample.coalesce(2))
    step = F.floor(F.col("score") * 100).cast("int")
    rest = _scored(trees, _assembled(labelled.where(~fits)))
    tally = rest.groupBy(F.col("c.kind").alias("kind"), step.alias("step")).agg(
        F.sum(label).alias("right"), F.count("*").alias("all")
    ).collect()  # at most 4 kinds times 101 steps
    thresholds = {}
    for kind in range(len(KINDS)):
        for at in range(50, 100):
            above = [row for row in tally if row["kind"] == kind and row["step"] >= at]
            if (total := sum(row["all"] for row in above)) and sum(row["right"] for row in above) >= precision * total:
                thresholds[kind] = at / 100
                break
    return SpanModel(trees, thresholds)


def personal_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] | None = None,
    max_candidates: int = 20_000, precision: float = 0.99,
) -> DataFrame:
    """Find e-mail and IP addresses, card and phone numbers in every whole text.

    Base spans are the valid matches of the fixed patterns and always stay. Generators of high recall propose candidates,
    which overlap; boosted trees, taught on which of them are base spans, score each by format and context; a candidate
    above its kind's calibrated threshold is added if it overlaps no base span and no added span to its left. So numbers
    that the base patterns lose, because a match ran on into the next number, are found.

    Returns the columns *carry* (default: all), ``base`` and ``spans``: arrays of ``(start, kind, end)`` in code points, end
    exclusive, by start and kind (index in KINDS). Input columns of these names are replaced. NULL and empty texts have
    empty arrays; repeated rows get equal spans; an empty table gives an empty result.
    """
    columns = list(docs.columns if carry is None else carry)
    rows = docs.select(
        packed(docs, columns).alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
    proposed = stored(propose(rows.withColumn("rid", F.monotonically_increasing_id())), "spans-proposed")
    model = fit_spans(proposed, max_candidates, precision)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if model.trees is None or not model.thresholds:
        return with_columns(proposed, columns, {"base": F.col("base"), "spans": F.col("base")})

    overlaps = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    fresh = F.filter("candidates", lambda c: ~F.exists("base", lambda b: overlaps(b, c)))
    candidates = proposed.select("rid", F.explode(fresh).alias("c"))
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in model.thresholds.items() for x in pair]), F.col("c.kind"))
    chosen = _scored(model.trees, _assembled(candidates)).where(F.col("score") >= limit)
    chosen = chosen.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(
        F.col("c.start").alias("start"), (-F.col("score")).alias("rank"), F.col("c.kind").alias("kind"), F.col("c.end").alias("end")
    ))).alias("chosen"))
    start = F.struct(F.lit(0).alias("end"), empty.alias("out"))
    added = F.aggregate(
        "chosen", start, lambda state, x: F.when(x["start"] >= state["end"], F.struct(
            x["end"].alias("end"), F.concat(state["out"], F.array(F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))).alias("out"),
        )).otherwise(state), lambda state: state["out"],
    )
    joined = proposed.select("rid", "row", "base").join(chosen.select("rid", added.alias("added")), "rid", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", empty)))
    return with_columns(joined, columns, {"base": F.col("base"), "spans": spans})


def _is_kind(code: int, x: Column) -> Column:
    return x["kind"] == code


def counted(spans: str, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, partial(_is_kind, KINDS.index(kind)))).cast("long")


def listed(spans: str) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")
