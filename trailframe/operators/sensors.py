"""Motion-sensor trials: trial flags, subject masks, subject attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe import schemas as S


def trial_is_long(trial: Column) -> Column:
    """True for the long trials, false for the short ones, null for any other number."""
    return F.when(trial.between(*S.LONG_TRIALS), True).when(trial.between(*S.SHORT_TRIALS), False)


def select_subjects(trials: DataFrame, mask: DataFrame) -> DataFrame:
    """Keep the chosen subjects of each trial; ``mask`` holds (trial type, trial number, subject) in the trials' names.

    Trials that the mask doesn't name are dropped.
    """
    keys = [S.TRIAL_TYPE, "trial number", S.TRIAL_SUBJECT]
    return trials.join(mask.select(*[F.col(f"`{k}`") for k in keys]), keys, "left_semi").select(*[
        F.col(f"`{c}`") for c in trials.columns])


def with_subject_info(trials: DataFrame, info: DataFrame) -> DataFrame:
    """Inner join on the subject; the info table's own key (its first column) is dropped."""
    key = info.columns[0]
    side = info.withColumnRenamed(key, "_subject")
    return trials.join(side, F.col(S.TRIAL_SUBJECT) == F.col("_subject")).drop("_subject")
