"""Schema matching: which canonical field a vendor header probably means.

The canonical fields are constants of the plan, so comparing a header with all of them is a
projection, not a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import normal_header, normalize_header
from rowmill.records import column

# Scores of the suggestion steps.
EQUAL_SCORE = 0.99
CONTAINED_SCORE = 0.7
LEAST_SIMILARITY = 0.5
EXACT_CONFIDENCE = 1.0
NORMALISED_CONFIDENCE = 0.95

BITS = 62
LOW, PLAIN, LENGTH, LETTERS = "__low", "__plain", "__length", "__letters"


def character_similarity(a: Column, b: Column) -> Column:
    """Distinct common characters over the longer length, 0 for an empty text."""
    common = F.size(F.array_intersect(F.split(a, ""), F.split(b, "")))
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), common / longer).otherwise(F.lit(0.0))


def _bits(text: Column, letters: str) -> list[Column]:
    """Which of the given letters a text has, one long for each ``BITS`` of them."""
    words = []
    for start in range(0, len(letters), BITS):
        word = F.lit(0).cast("bigint")
        for bit, letter in enumerate(letters[start : start + BITS]):
            word = word.bitwiseOR(F.when(F.contains(text, F.lit(letter)), F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        words.append(word)
    return words


class _Asked:
    """Distinct headers with what scoring needs of each, computed once in a projection of its
    own: its lower text, its length and its letters as bit sets.

    What belongs to a canonical field alone is a constant of the plan, so a header meets a
    field in a few comparisons of generated code. Letters that no field has are never common.
    """

    def __init__(self, headers: DataFrame, canonical: list[str], header: str):
        self.fields = list(dict.fromkeys(canonical))
        self.lows = [f.lower() for f in self.fields]
        self.letters = "".join(dict.fromkeys("".join(self.lows)))
        one = headers.select(header).distinct()
        low = one.withColumns({LOW: F.lower(column(header)), PLAIN: normalize_header(column(header))})
        words = _bits(F.col(LOW), self.letters)
        self.rows = low.withColumns({LENGTH: F.length(LOW), **{f"{LETTERS}{i}": w for i, w in enumerate(words)}})

    def _similarity(self, low: str) -> Column:
        """Distinct common letters over the longer length."""
        sets = []
        for i, start in enumerate(range(0, len(self.letters), BITS)):
            own = sum(1 << b for b, x in enumerate(self.letters[start : start + BITS]) if x in low)
            if own:
                sets.append(F.bit_count(F.col(f"{LETTERS}{i}").bitwiseAND(F.lit(own).cast("bigint"))))
        common = sum(sets[1:], sets[0]) if sets else F.lit(0)
        return common / F.greatest(F.col(LENGTH), F.lit(len(low)))

    def suggestions(self) -> Column:
        """Scored fields, best first; of equal ones the first listed."""
        hits = []
        for at, (name, low) in enumerate(zip(self.fields, self.lows)):
            similar = self._similarity(low)
            score = (
                F.when(F.col(LOW) == low, F.lit(EQUAL_SCORE))
                .when(F.contains(LOW, F.lit(low)) | F.contains(F.lit(low), F.col(LOW)), F.lit(CONTAINED_SCORE))
                .when(similar > LEAST_SIMILARITY, similar)
            )
            hit = F.struct((-score).alias("cost"), F.lit(at).alias("listed_at"), F.lit(name).alias("canonical_field"))
            hits.append(F.when(score.isNotNull(), hit))
        kind = "array<struct<cost: double, listed_at: int, canonical_field: string>>"
        return F.array_sort(F.array_compact(F.array(*hits).cast(kind)))

    def certain(self) -> tuple[Column, Column]:
        """The first field equal ignoring case, and the first equal without punctuation."""
        none = F.lit(None).cast("string")
        exact = [F.when(F.col(LOW) == low, F.lit(f)) for f, low in zip(self.fields, self.lows)]
        loose = [F.when(F.col(PLAIN) == normal_header(f), F.lit(f)) for f in self.fields]
        return F.coalesce(*exact, none), F.coalesce(*loose, none)


def suggest_mapping(headers: DataFrame, canonical: list[str], header: str = "header") -> DataFrame:
    """All suggestions: ``header, canonical_field, score, rank`` (best first, ties as listed).

    Headers are made distinct first; the ranking is done inside the row, over an
    array as long as the canonical field list.
    """
    asked = _Asked(headers, canonical, header)
    return asked.rows.select(header, F.posexplode(asked.suggestions()).alias("at", "hit")).select(
        header,
        F.col("hit.canonical_field").alias("canonical_field"),
        (-F.col("hit.cost")).alias("score"),
        (F.col("at") + 1).cast("bigint").alias("rank"),
    )


def best_suggestion(headers: DataFrame, canonical: list[str], header: str = "header") -> DataFrame:
    """The best suggestion per header."""
    return suggest_mapping(headers, canonical, header).where("rank = 1").drop("rank")


def _hit(field: Column, confidence: float | Column, rationale: str) -> Column:
    return F.when(
        field.isNotNull(),
        F.struct(
            field.alias("canonical_field"),
            (F.lit(confidence) if isinstance(confidence, float) else confidence).alias("confidence"),
            F.lit(rationale).alias("rationale"),
        ),
    )


def match_headers(headers: DataFrame, canonical: list[str], header: str = "header") -> DataFrame:
    """Certain matches: ``header, canonical_field, confidence, rationale``.

    Equal ignoring case, and equal after dropping punctuation; a header that matches
    exactly yields both. Of several equal fields the first listed is taken.
    """
    asked = _Asked(headers, canonical, header)
    exact, loose = asked.certain()
    hits = F.array_compact(
        F.array(_hit(exact, EXACT_CONFIDENCE, "Exact match"), _hit(loose, NORMALISED_CONFIDENCE, "Normalized match"))
    )
    return asked.rows.select(header, F.explode(hits).alias("hit")).select(header, "hit.*")


def unmatched_headers(headers: DataFrame, canonical: list[str], header: str = "header") -> DataFrame:
    """Headers without any certain match."""
    asked = _Asked(headers, canonical, header)
    exact, loose = asked.certain()
    return asked.rows.where(column(header).isNotNull() & exact.isNull() & loose.isNull()).select(header)


def propose_mapping(headers: DataFrame, canonical: list[str], header: str = "header") -> DataFrame:
    """One proposal per header, in the order exact, normalised, suggested."""
    asked = _Asked(headers, canonical, header)
    exact, loose = asked.certain()
    rows = asked.rows.withColumns({"__exact": exact, "__loose": loose})
    best = F.when(F.col("__exact").isNull() & F.col("__loose").isNull(), F.get(asked.suggestions(), F.lit(0)))
    rows = rows.withColumn("__best", best)
    hit = F.coalesce(
        _hit(F.col("__exact"), EXACT_CONFIDENCE, "Exact match"),
        _hit(F.col("__loose"), NORMALISED_CONFIDENCE, "Normalized match"),
        _hit(F.col("__best.canonical_field"), -F.col("__best.cost"), "Suggested"),
    )
    # a filter on the hit would be taken below and score every header again
    return rows.select(header, F.explode(F.array_compact(F.array(hit))).alias("hit")).select(header, "hit.*")
