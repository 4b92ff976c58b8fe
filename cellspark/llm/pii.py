"""Personal data: candidate spans scored by boosted trees over format and context features.

Patterns of high recall propose spans of four kinds, which may overlap. Each candidate is described by a few
yes/no features of its format and context. Spans that pass the strict base rule of their kind are the positive
examples; one aggregation counts positives and negatives for every combination of features (at most
2 ** features rows per kind and fold, whatever the input), and boosted trees of depth two are fitted to those
counts, which is the same as fitting them to all candidates. The threshold of a kind is the lowest score whose
precision on the held-back fold is high enough. The trees go back into the plan as an expression, so finding
and redacting run without user functions. Base spans always stay; chosen candidates that touch no base span of
their kind are added.

Defined cases: a null or empty text has no spans; repeated rows are searched alike; ties in the order of spans
are broken by kind, then end; a table without candidates gives trees without weight and adds nothing; a null id
counts for fitting, not for calibration; other columns are passed through (:func:`find`) and may have any name
but those starting with ``_pii``. Positions are code points. A text with n matches costs n * n small copies.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import fold

KINDS = ("email", "ip", "card", "phone")

# Base patterns. Possessive and anchored at the start of a run, so that a long run is read once.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Candidates of high recall.
BROAD = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|[(\[]at[)\]])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,5}+",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}+",
    "phone": r"(?<![0-9])\+?\(?[0-9][\x20().0-9-]{6,20}[0-9]",
}

# A text without this has no candidate of the kind.
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20.-]?[0-9]", "phone": r"[0-9][\x20().0-9-]{6}"}

CONTEXT = 24


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check sum of a string of at most 19 digits."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for place in range(20):
        digit = F.substring(padded, place + 1, 1).cast("int")
        doubled = digit * 2
        total = total + (digit if place % 2 else doubled - F.when(doubled > 9, F.lit(9)).otherwise(F.lit(0)))
    return total % 10 == 0


def is_base(kind: str, match: Column) -> Column:
    """Whether a match of the base pattern holds what the kind asks for."""
    digits = _digits(match)
    if kind == "ip":
        return ~F.exists(F.split(match, r"\."), lambda part: F.length(F.regexp_replace(part, "^0+(?=.)", "")) > 3) & F.coalesce(
            ~F.exists(F.split(match, r"\."), lambda part: F.substring(part, -4, 4).cast("int") > 255), F.lit(False)
        )
    if kind == "card":
        return F.length(digits).between(12, 19) & F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def features(kind: str, match: Column, before: Column, after: Column) -> list[Column]:
    """Yes/no features of a candidate: its format, then its context."""
    digits = _digits(match)
    own = {
        "email": [
            F.instr(match, "@") > 0,
            match.rlike(r"(?i)(?:\.|dot[)\]]\x20?)[a-z]{2,10}$"),
            match.rlike(r"^[A-Za-z0-9._%+-]{2,40}\x20?[@(\[]"),
            ~F.contains(match, F.lit("..")),
        ],
        "ip": [
            F.size(F.split(match, r"\.")) == 4,
            ~match.rlike(r"[0-9]{4}"),
            ~match.rlike(r"(?:^|\.)(?:2[6-9]|25[6-9]|[3-9][0-9])[0-9](?:\.|$)"),
            ~match.rlike(r"(?:^|\.)0[0-9]"),
        ],
        "card": [
            F.length(digits).between(13, 19),
            match.rlike(r"^[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$"),
            match.rlike(r"^[3-6]"),
            _luhn(F.substring(digits, 1, 19)),
        ],
        "phone": [
            F.length(digits).between(9, 15),
            match.rlike(r"\([0-9]{2,4}\)"),
            match.rlike(r"[0-9]{3}[\x20.-][0-9]{4}$"),
            F.regexp_count(match, F.lit(r"[\x20().-]+")) >= 2,
        ],
    }[kind]
    words = {"email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|credit|pay", "phone": "tel|phone|call|mobile|fax"}[kind]
    context = [
        before.rlike(r"(?:^|[\s,;:(<\"'])$"),
        after.rlike(r"^(?:$|[\s,;:.)>\"'!?])"),
        before.rlike(rf"(?i)\b(?:{words})"),
    ]
    return own + context


def _cut(text: Column, kind: str, pattern: str) -> tuple[Column, Column]:
    """The matches of a pattern, and the text between them (one piece more); both empty where none can be."""
    some = text.rlike(NEEDS[kind])
    none = F.array().cast("array<string>")
    return (
        F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
        F.when(some, F.split(text, pattern, -1)).otherwise(none),
    )


def _walk(kind: str, found: str, gaps: str, entry, entry_type: str) -> Column:
    """Entries for the matches of a text, in order; ``entry(match, start, before, after)`` may be null."""
    steps = F.zip_with(
        F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
        F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0))),
        lambda x, after: F.struct(x["m"].alias("m"), x["g"].alias("g"), after.alias("after")),
    )

    def step(state, x):
        start = state["at"] + F.length(x["g"])
        made = entry(x["m"], start, F.substring(x["g"], -CONTEXT, CONTEXT), F.substring(x["after"], 1, CONTEXT))
        return F.struct(
            (start + F.length(x["m"])).alias("at"),
            F.when(made.isNull(), state["out"]).otherwise(F.array_append(state["out"], made)).alias("out"),
        )

    matched = F.filter(steps, lambda x: x["m"].isNotNull())
    return F.aggregate(matched, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{entry_type}>").alias("out")), step)["out"]


def _with_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_pii_base`` (strict spans) and ``_pii_wide_<kind>`` (candidates with their features as bits)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cuts = {}
    for kind in KINDS:
        cuts[f"_pii_f_{kind}"], cuts[f"_pii_g_{kind}"] = _cut(text, kind, BASE[kind])
        cuts[f"_pii_F_{kind}_wide"], cuts[f"_pii_G_{kind}_wide"] = _cut(text, kind, BROAD[kind])
    cut = docs.withColumns(cuts)

    def base_entry(kind):
        rank = KINDS.index(kind)

        def entry(m, start, before, after):
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(m)).alias("end"))
            return F.when(is_base(kind, m), span)

        return entry

    def wide_entry(kind):
        def entry(m, start, before, after):
            bits = F.lit(0)
            for place, feature in enumerate(features(kind, m, before, after)):
                bits = bits + F.when(feature, F.lit(1 << place)).otherwise(F.lit(0))
            strict = m.rlike(f"^(?:{BASE[kind]})$") & is_base(kind, m)
            return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), bits.alias("bits"), strict.alias("strict"))

        return entry

    span_type, wide_type = "struct<start:int,rank:int,end:int>", "struct<start:int,end:int,bits:int,strict:boolean>"
    base = [_walk(k, f"_pii_f_{k}", f"_pii_g_{k}", base_entry(k), span_type) for k in KINDS]
    wide = {f"_pii_wide_{k}": _walk(k, f"_pii_F_{k}_wide", f"_pii_G_{k}_wide", wide_entry(k), wide_type) for k in KINDS}
    return cut.withColumns({"_pii_base": F.concat(*base), **wide}).drop(*cuts)


@dataclass
class Trees:
    """Boosted trees of one kind: (feature a, feature b, weights for the four answers), and the score to reach."""

    trees: list[tuple[int, int, tuple[float, float, float, float]]] = field(default_factory=list)
    threshold: float = math.inf

    def score(self, bits: int) -> float:
        return sum(w[(bits >> a & 1) * 2 + (bits >> b & 1)] for a, b, w in self.trees)

    def expression(self, bits: Column) -> Column:
        total = F.lit(0.0)
        for a, b, w in self.trees:
            place = F.getbit(bits, F.lit(a)) * 2 + F.getbit(bits, F.lit(b))
            total = total + F.element_at(F.array(*[F.lit(float(x)) for x in w]), (place + 1).cast("int"))
        return total


def _boost(cells: dict[int, tuple[int, int]], rounds: int = 12, shrink: float = 0.5) -> Trees:
    """Fit trees to counts (positive, negative) per combination of features; Newton steps on the log loss."""
    model = Trees()
    width = 7
    for _ in range(rounds if cells else 0):
        best = None
        for a in range(width):
            for b in range(a, width):
                grad, hess = [0.0] * 4, [0.0] * 4
                for bits, (pos, neg) in cells.items():
                    p = 1 / (1 + math.exp(-model.score(bits)))
                    leaf = (bits >> a & 1) * 2 + (bits >> b & 1)
                    grad[leaf] += pos * (1 - p) - neg * p
                    hess[leaf] += (pos + neg) * p * (1 - p)
                gain = sum(g * g / (h + 1.0) for g, h in zip(grad, hess, strict=True))
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, a, b, tuple(max(-2.0, min(2.0, shrink * g / (h + 1.0))) for g, h in zip(grad, hess, strict=True)))
        model.trees.append(best[1:])
    return model


def fit(docs: DataFrame, precision: float = 0.98, support: int = 20) -> dict[str, Trees]:
    """Trees and thresholds for every kind, from the candidates of all documents.

    One document in four is held back by the crc32 of its id; a threshold is taken only where at least
    ``support`` held-back candidates reach it.
    """
    spans = _with_spans(docs.select("doc_id", "text"))

    def described(kind):
        return F.transform(f"_pii_wide_{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), x["bits"].alias("bits"), x["strict"].alias("strict")))

    entries = F.concat(*[described(kind) for kind in KINDS])
    held = F.coalesce(fold("doc_id", 4) == 0, F.lit(False))
    rows = spans.select(held.alias("held"), F.explode(entries).alias("x")).groupBy("held", "x.kind", "x.bits").agg(
        F.count_if("x.strict").alias("pos"), F.count_if(~F.col("x.strict")).alias("neg")
    )
    cells = rows.collect()  # at most 2 folds * 4 kinds * 128 combinations
    models = {}
    for kind in KINDS:
        model = _boost({r["bits"]: (r["pos"], r["neg"]) for r in sorted(cells) if r["kind"] == kind and not r["held"]})
        reached = positive = 0
        for score, pos, neg in sorted(((model.score(r["bits"]), r["pos"], r["neg"]) for r in cells if r["kind"] == kind and r["held"]), reverse=True):
            reached, positive = reached + pos + neg, positive + pos
            if reached >= support and positive >= precision * reached:
                model.threshold = score
        models[kind] = model
    return models


def find(docs: DataFrame, models: dict[str, Trees]) -> DataFrame:
    """All columns of ``docs``, and ``_pii_base`` and ``_pii_spans``: sorted spans ``(start, rank, end)``."""
    spans = _with_spans(docs)

    def chosen(kind: str) -> Column:
        rank, model = KINDS.index(kind), models[kind]

        def enough(x: Column) -> Column:
            apart = ~F.exists("_pii_base", lambda b: (b["rank"] == rank) & (b["start"] < x["end"]) & (x["start"] < b["end"]))
            return (model.expression(x["bits"]) >= model.threshold - 1e-9) & apart

        return F.transform(
            F.filter(f"_pii_wide_{kind}", enough), lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"))
        )

    added = [chosen(kind) for kind in KINDS if models[kind].trees and models[kind].threshold < math.inf]
    everything = F.concat("_pii_base", *added)
    return spans.withColumns({"_pii_spans": F.array_sort(everything), "_pii_base": F.array_sort("_pii_base")}).drop(*[f"_pii_wide_{k}" for k in KINDS])


def number(spans: str, kind: str) -> Column:
    """How many spans are of a kind."""
    rank = KINDS.index(kind)
    return F.size(F.filter(spans, lambda x: x["rank"] == rank)).cast("long")


def written(spans: str) -> Column:
    """Spans as text, ``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, models: dict[str, Trees]) -> DataFrame:
    """The same columns, with every span of ``text`` replaced by its kind in angle brackets; overlapping spans become one."""
    tags = F.array(*[F.lit(f"<{k}>") for k in KINDS])

    def step(state, x):
        fresh = x["start"] >= state["at"]
        pieces = F.array(F.substring(F.col("text"), state["at"] + 1, x["start"] - state["at"]), F.get(tags, x["rank"]))
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"), F.when(fresh, F.concat(state["out"], pieces)).otherwise(state["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    found = find(docs, models).withColumn("_pii_done", F.aggregate("_pii_spans", start, step))
    rest = F.expr("substring(text, _pii_done.at + 1)")
    text = F.when(F.size("_pii_spans") == 0, F.col("text")).otherwise(F.concat(F.array_join("_pii_done.out", ""), rest))
    return found.withColumn("text", F.when(F.col("text").isNull(), F.col("text")).otherwise(text)).select(*docs.columns)
