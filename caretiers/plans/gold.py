"""Gold aggregates."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretiers.contracts import ObservationsPerPatient
from caretiers.functions.dates import age_in_years, parse_iso_date
from caretiers.typed import TypedDataFrame, plain


def build_observations_per_patient(
    patients: DataFrame | TypedDataFrame,
    observations: DataFrame | TypedDataFrame,
    *,
    as_of: datetime.date | None = None,
) -> ObservationsPerPatient:
    """Observations, birth date and age (at ``as_of``, today by default) of every patient.

    Patients without observations stay, with 0. Copies of a patient with the same birth date are
    one row, and each copy counts the observations again, as a join before grouping would.

    Both sides are counted before the join, with map-side partial counts, so a subject or a
    patient (or a missing id) that holds most of the rows crosses the shuffle as a few rows.
    What is left to skew is handled by the adaptive skew join.
    """
    per_patient = plain(patients).groupBy("id", "birth_date").agg(F.count("*").alias("copies"))
    per_subject = (
        plain(observations)
        .where(F.col("subject_id").isNotNull())
        .groupBy("subject_id")
        .agg(F.count("id").alias("found"))
    )
    birth_date = parse_iso_date(F.col("birth_date"))
    joined = per_patient.join(per_subject, F.col("id") == F.col("subject_id"), "left").select(
        F.col("id").alias("patient_id"),
        (F.col("copies") * F.coalesce("found", F.lit(0))).alias("observation_count"),
        birth_date.alias("birth_date"),
    )
    today = F.lit(as_of) if as_of else F.current_date()
    return ObservationsPerPatient.from_df(
        joined.withColumn("patient_age_years", age_in_years(F.col("birth_date"), today))
    )


def ranked_by_count(gold: DataFrame | TypedDataFrame) -> DataFrame:
    """Patients by falling number of observations."""
    return plain(gold).select("patient_id", "observation_count").orderBy(F.desc("observation_count"), "patient_id")


def concentration(gold: DataFrame | TypedDataFrame) -> DataFrame:
    """Observations of the most active fifth of the patients against those of the others.

    One row: ``top_patients`` (a fifth, rounded down), ``top_observations``,
    ``other_observations`` and ``is_concentrated`` (top > other).

    The patients are not sorted. They are counted per number of observations, and the running
    sums go over these few distinct numbers: N observations have at most sqrt(2 N) of them.
    """
    histogram = plain(gold).groupBy("observation_count").agg(F.count("*").alias("patients"))
    # One row holding the histogram, highest count first.
    counts = histogram.agg(
        F.coalesce(F.sum("patients"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("patients") * F.col("observation_count")), F.lit(0)).alias("observations"),
        F.sort_array(F.collect_list(F.struct("observation_count", "patients")), asc=False).alias("bars"),
    ).withColumn("top_patients", F.floor(F.col("total") / 5).cast("long"))
    state = F.struct(F.col("top_patients").alias("left"), F.lit(0).cast("long").alias("taken"))

    def take(acc, bar):
        n = F.least(acc.left, bar.patients)
        return F.struct((acc.left - n).alias("left"), (acc.taken + n * bar.observation_count).alias("taken"))

    top = F.aggregate("bars", state, take, lambda acc: acc.taken)
    split = counts.select("top_patients", top.alias("top_observations"), "observations")
    other = F.col("observations") - F.col("top_observations")
    return split.select(
        "top_patients",
        "top_observations",
        other.alias("other_observations"),
        (F.col("top_observations") > other).alias("is_concentrated"),
    )
