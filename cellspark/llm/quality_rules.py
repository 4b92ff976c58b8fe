"""Quality rules: a table of thresholds compiled into one projection of length, symbol, stop-word and line ratios.

Nothing here is a user function. Numbers about one text are array expressions over its words, so a row is
judged where it lies and the plan has no shuffle. Defined cases: a null text has no words; an empty text fails
the length rules; a ratio over nothing is 0; repeated rows and equal ids are judged row by row; other columns
of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import BLANKS, any_of

WINDOW = 5

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

# Very common short words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is it that was for on are with as be this by from at or an "
    "le la les de des et un une en du que est pour dans qui sur pas au avec être "
    "der die das und ist nicht ein eine zu den mit von auf für im sich des dem auch "
    "el los las y que no su por se lo del con para al más o"
).split()


@dataclass(frozen=True)
class Rule:
    """A text fails where the measure lies under ``least`` or over ``most``; only texts of ``from_words`` words or more are asked."""

    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


# The base rules and the method's own table.
BASE_RULES = (Rule("n_words", least=10), Rule("repeat_ratio", most=0.20))
RULES = (
    Rule("mean_word_chars", least=2, most=14),
    Rule("symbol_ratio", most=0.10),
    Rule("dup_line_ratio", most=0.50),
    Rule("stop_ratio", least=0.02, from_words=40),
    Rule("upper_ratio", most=0.60, from_words=10),
    Rule("end_mark_ratio", most=0.60, from_words=10),
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{BLANKS}]+"), "")


def _windows(texts: DataFrame) -> DataFrame:
    """Adds the words inside windows that occur twice or more.

    Windows are hashed; only texts with equal hashes sort theirs. The sorted starts of repeated windows then
    cover ``min(WINDOW, gap to the next start)`` words each. Arrays that a lambda looks into are columns of
    their own and used more than once, so they are built once per row and not once per element.
    """
    n_windows = F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))
    nothing = F.lit(None).cast("array<struct<h:bigint,i:int>>")
    placed = F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(x: Column, k: Column) -> Column:
        same = [F.get("_placed", k + step)["h"] == x["h"] for step in (-1, 1)]
        return F.when(any_of([F.coalesce(s, F.lit(False)) for s in same]), x["i"])

    return (
        texts.withColumn("_codes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn(
            "_hashes",
            F.transform(
                F.slice("_codes", F.lit(1), n_windows),
                lambda first, i: F.xxhash64(first, *[F.get("_codes", i + k) for k in range(1, WINDOW)]),
            ),
        )
        .withColumn("_placed", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), placed).otherwise(nothing))
        .withColumn("_starts", F.array_sort(F.array_compact(F.transform("_placed", again))))
        .withColumn(
            "n_repeat_words",
            F.coalesce(
                F.aggregate(
                    F.transform("_starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - s, F.lit(WINDOW)))),
                    F.lit(0).cast("long"),
                    lambda total, x: total + x,
                ),
                F.lit(0).cast("long"),
            ),
        )
    )


def measure(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id`` and the counts that the rules are made of."""
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))

    def count_of(characters: str) -> Column:
        return F.regexp_count("_text", F.lit(f"[{characters}]")).cast("long")

    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    texts = texts.withColumn("_words", _words(F.col("_text"))).withColumn("_lines", lines)
    return _windows(texts).select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        count_of(SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        count_of("A-Z").alias("n_upper"),
        count_of("!?").alias("n_marks"),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) == 0, F.lit(0.0)).otherwise(F.col(part).cast("double") / F.col(whole))


def measures() -> dict[str, Column]:
    """What a rule may name, over the columns of :func:`measure`."""
    return {
        "n_words": F.col("n_words").cast("double"),
        "repeat_ratio": _ratio("n_repeat_words", "n_words"),
        "mean_word_chars": _ratio("word_chars", "n_words"),
        "symbol_ratio": _ratio("n_symbols", "word_chars"),
        "dup_line_ratio": _ratio("n_dup_lines", "n_lines"),
        "stop_ratio": _ratio("n_stop_words", "n_words"),
        "upper_ratio": _ratio("n_upper", "word_chars"),
        "end_mark_ratio": _ratio("n_marks", "n_words"),
    }


def fails(rules: tuple[Rule, ...]) -> Column:
    """The rules as one Boolean expression."""
    known = measures()
    broken = []
    for rule in rules:
        value = known[rule.measure]
        beyond = [value < rule.least] if rule.least is not None else []
        beyond += [value > rule.most] if rule.most is not None else []
        broken.append((F.col("n_words") >= rule.from_words) & any_of(beyond))
    return any_of(broken)


def judge(docs: DataFrame, base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row the counts, ``base_failed`` and ``kept`` (neither a base rule nor one of ``rules`` broken)."""
    return measure(docs).withColumn("base_failed", fails(base)).withColumn("kept", ~F.col("base_failed") & ~fails(rules))
