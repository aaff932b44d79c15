"""Lifted weight and energy of a set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import contains_ci

# Fixed values of the energy formula.
LB_TO_KG = 0.453592
KM_TO_MILES = 0.621371
DEFAULT_MET = 5.0
DEFAULT_USER_LBS = 160.0
DEFAULT_BODY_KG = 72.0
BAR_LBS = 45
SECONDS_PER_REP = 3
FALLBACK_REPS_PER_MINUTE = 20
FALLBACK_MIN_MINUTES = 0.3


@dataclass(frozen=True)
class WeightWords:
    """Words that decide how a logged weight is expanded, tried in this order."""

    barbell: str = "barbell"
    assisted: str = "assisted"
    smith: str = "smith"
    pull_up: str = "pull up"
    dip_note: str = "chest dip"


def pounds_to_kg(pounds: Column) -> Column:
    return pounds * F.lit(LB_TO_KG)


def km_to_miles(km: Column) -> Column:
    return km * F.lit(KM_TO_MILES)


def effective_weight(
    weight: Column, exercise: Column, notes: Column, user_lbs: Column, words: WeightWords = WeightWords()
) -> Column:
    """Weight moved: two plates and a bar, body less help, both sides, or the body itself."""
    return (
        F.when(contains_ci(exercise, words.barbell), weight * 2 + BAR_LBS)
        .when(contains_ci(exercise, words.assisted), user_lbs - weight)
        .when(contains_ci(exercise, words.smith) | contains_ci(notes, words.smith), weight * 2)
        .when(contains_ci(exercise, words.pull_up) | contains_ci(notes, words.dip_note), user_lbs)
        .otherwise(weight)
    )


def set_calories(met: Column, reps: Column, seconds: Column, user_lbs: Column) -> Column:
    """Energy of a set from its intensity and its time; without a time, three seconds a rep."""
    timed = F.coalesce(seconds, F.lit(0)) != 0
    minutes = F.when(timed, seconds / 60).otherwise(reps * SECONDS_PER_REP / 60)
    return met * 3.5 * pounds_to_kg(user_lbs) / 200 * minutes


def fallback_set_calories(met: Column, reps: Column, body_kg: float = DEFAULT_BODY_KG) -> Column:
    minutes = F.greatest(F.lit(FALLBACK_MIN_MINUTES), reps / FALLBACK_REPS_PER_MINUTE)
    return met * 3.5 * F.lit(body_kg) / 200 * minutes


def is_weighted(weight: Column) -> Column:
    return F.coalesce(weight, F.lit(0)) != 0
