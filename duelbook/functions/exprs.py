"""Column functions of the domain: predicates, buckets, text and date pieces, probabilities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def ratio(a, b) -> Column:
    """a / b as a double; null where b is zero."""
    return c(a).cast("double") / F.nullif(c(b).cast("double"), F.lit(0.0))


def share(cond: Column) -> Column:
    """Mean of a condition over all rows of a group; unknown counts as false."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def share_if(cond: Column, where: Column) -> Column:
    """Mean of a condition over the rows where another holds."""
    return F.avg(F.when(where, F.when(cond, 1.0).otherwise(0.0)))


def avg_if(value, where: Column) -> Column:
    return F.avg(F.when(where, c(value)))


def sum_if(value, where: Column) -> Column:
    return F.sum(F.when(where, c(value)))


def count_if(where: Column) -> Column:
    return F.count_if(F.coalesce(where, F.lit(False)))


def enough(value: Column, n: Column, least: int) -> Column:
    """The value only where the group has enough rows."""
    return F.when(n >= least, value)


def all_of(*conditions: Column | None) -> Column:
    """AND of those conditions that are given: the optional-parameter predicate."""
    return reduce(lambda a, b: a & b, [x for x in conditions if x is not None], F.lit(True))


def optional(column, value) -> Column | None:
    """column = value, or no condition where no value is asked for."""
    return None if value is None else c(column) == value


def is_garbage_time(period="period", diff="score_diff") -> Column:
    """Whether a contest is decided: a lead over 28 in period 4, or over 35 from period 3 on; an unknown lead is 0."""
    lead = F.abs(F.coalesce(c(diff), F.lit(0)))
    return F.coalesce(((c(period) == 4) & (lead > 28)) | ((c(period) >= 3) & (lead > 35)), F.lit(False))


GARBAGE_SQL = "coalesce((period = 4 AND abs(coalesce(score_diff, 0)) > 28) OR (period >= 3 AND abs(coalesce(score_diff, 0)) > 35), false)"


def contains(column, *parts: str) -> Column:
    """Case-insensitive: holds any of the parts."""
    return reduce(lambda a, b: a | b, [c(column).ilike(f"%{p}%") for p in parts])


def play_category(kind="play_type") -> Column:
    return F.when(contains(kind, "rush", "run"), "rush").when(contains(kind, "pass", "sack"), "pass").otherwise("other")


CATEGORY_SQL = "CASE WHEN play_type ILIKE '%rush%' OR play_type ILIKE '%run%' THEN 'rush' WHEN play_type ILIKE '%pass%' OR play_type ILIKE '%sack%' THEN 'pass' ELSE 'other' END"


def bucket(column, steps: list[tuple[float, str]], other: str) -> Column:
    """First label whose bound the value does not exceed; ``other`` above all, and for null."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for bound, label in steps:
        out = out.when(c(column) <= bound, label)
    return out.otherwise(other)


def floor_bucket(column, steps: list[tuple[float, str]], other: str) -> Column:
    """First label whose bound the value reaches; ``other`` below all, and for null."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for bound, label in steps:
        out = out.when(c(column) >= bound, label)
    return out.otherwise(other)


def down_situation() -> Column:
    down, far = F.col("down"), F.col("distance")
    return (
        F.when(down == 1, "first").when((down == 2) & (far <= 4), "second_short").when(down == 2, "second_long").when((down == 3) & (far <= 3), "third_short")
        .when((down == 3) & (far <= 7), "third_medium").when(down == 3, "third_long").when(down == 4, "fourth").otherwise("other")
    )


def score_state(diff="score_diff") -> Column:
    """Five states of the lead, seen from the side with the ball; an unknown lead is a tie."""
    return floor_bucket(F.coalesce(c(diff), F.lit(0)), [(14, "big_lead"), (1, "small_lead"), (0, "tied"), (-13, "small_deficit")], "big_deficit")


SCORE_STATE_SQL = "CASE WHEN coalesce(score_diff, 0) >= 14 THEN 'big_lead' WHEN coalesce(score_diff, 0) >= 1 THEN 'small_lead' WHEN coalesce(score_diff, 0) = 0 THEN 'tied' WHEN coalesce(score_diff, 0) >= -13 THEN 'small_deficit' ELSE 'big_deficit' END"


def week_index(week="week", kind="season_type") -> Column:
    """A week number that goes on in the postseason, where weeks start again at 1."""
    return F.when(c(kind) == "postseason", c(week) + 100).otherwise(c(week))


def season_of(date) -> Column:
    """The season a date belongs to: from August on its own year, before that the year before."""
    return F.year(c(date)) - F.when(F.month(c(date)) < 8, 1).otherwise(0)


def height_inches(text) -> Column:
    """"6-2" as 74; null where it is not feet-inches."""
    part = F.split(c(text), "-")
    return F.try_add(F.get(part, F.lit(0)).try_cast("int") * 12, F.get(part, F.lit(1)).try_cast("int"))


def seconds_remaining(period, clock, length: int = 900, periods: int = 4) -> Column:
    """Seconds left from a period number and "MM:SS"; 0 in extra periods, null where the clock is malformed."""
    part = F.split(c(clock), ":")
    left = F.get(part, F.lit(0)).try_cast("int") * 60 + F.get(part, F.lit(1)).try_cast("int")
    return F.when(c(period) > periods, F.lit(0)).when(F.size(part) == 2, left + (periods - c(period)) * length)


STATE_SECONDS_SQL = "(4 - period) * 900 + clock_minutes * 60 + clock_seconds"


def state_hash(*columns, null: str = "") -> Column:
    """md5 of the fields joined by a bar; how null is written is the caller's choice."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c(x).cast("string"), F.lit(null)) for x in columns]))


def win_expectancy(diff) -> Column:
    """Logistic on the 400 scale."""
    return 1 / (1 + F.pow(F.lit(10.0), -c(diff) / 400.0))


def carry_over(rating, seed: float = 1500.0, keep: float | Column = 2 / 3) -> Column:
    """A rating at a new season's start: pulled towards the seed."""
    return c(rating) * keep + seed * (1 - keep)


def normal_cdf(z) -> Column:
    """Standard normal distribution function; rational approximation (Abramowitz and Stegun 7.1.26), error under 1.5e-7."""
    x = F.abs(c(z)) / (2**0.5)
    t = 1 / (1 + 0.3275911 * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1 - series * F.exp(-x * x)
    return F.when(c(z) >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)


def live_win_probability(margin, expected, seconds, sigma: float = 16.0, total: int = 3600) -> Column:
    """Chance that the leader-to-be wins: what is left of the expected margin, over what is left of the spread."""
    left = c(seconds) / float(total)
    z = (c(margin) + c(expected) * left) / (sigma * F.sqrt(left))
    return F.when(left > 0, normal_cdf(z)).when(c(margin) > 0, 1.0).when(c(margin) < 0, 0.0).otherwise(0.5)


def normal_name(text) -> Column:
    """Trimmed, inner blanks as one, lower case."""
    return F.lower(F.regexp_replace(F.trim(c(text)), r"\s+", " "))


def trigrams(text) -> Column:
    """Distinct trigrams of the words of a text, each with two blanks before and one after."""
    parts = F.filter(F.split(F.lower(c(text)), "[^a-z0-9]+"), lambda w: w != "")
    grams = F.transform(parts, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a, b) -> Column:
    """Shared trigrams over all trigrams."""
    x, y = trigrams(a), trigrams(b)
    return ratio(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y)))


def edit_similarity(a, b) -> Column:
    """One less the edit distance over the longer length."""
    return 1 - ratio(F.levenshtein(c(a), c(b)), F.greatest(F.length(c(a)), F.length(c(b))))


def matched(text, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null where nothing matches."""
    return F.nullif(F.regexp_extract(c(text), pattern, group), F.lit(""))
