import datetime
import random

import pytest
from pyspark.sql import functions as F

from caretiers.contracts import Observation, Patient
from caretiers.plans.gold import build_observations_per_patient, concentration, ranked_by_count

AS_OF = datetime.date(2025, 1, 1)


def frames(patients, observations):
    observation_rows = [{"id": o, "subject_id": s, "component_count": 0, "validation_errors": []} for o, s in observations]
    return (
        Patient.from_dicts([{"id": p, "birth_date": b, "validation_errors": []} for p, b in patients]),
        Observation.from_dicts(observation_rows),
    )


def naive(patients, observations):
    """Join, then group: every pair of a patient row and an observation of its id."""
    counts = {}
    for patient in patients:
        found = [o for o, subject in observations if subject is not None and subject == patient[0]]
        counts[patient] = counts.get(patient, 0) + sum(o is not None for o in found)
    return counts


def test_counts_and_ages(spark):
    patients = [("anna", "1984-06-30"), ("otto", "soon"), ("eve", None)]
    observations = [("pulse", "anna"), ("weight", "anna"), ("gait", "eve"), ("lost", None), ("foreign", "bob")]
    gold = build_observations_per_patient(*frames(patients, observations), as_of=AS_OF)
    assert gold.columns == ["patient_id", "observation_count", "birth_date", "patient_age_years"]
    assert sorted(map(tuple, gold.collect())) == [
        ("anna", 2, datetime.date(1984, 6, 30), 40),
        ("eve", 1, None, None),
        ("otto", 0, None, None),
    ]


def test_same_counts_as_join_then_group(spark):
    rng = random.Random(7)
    ids = [None, "a", "b", "c", "d"]
    dates = [None, "2000-01-01", "1999-12-31", "x"]
    patients = [(rng.choice(ids), rng.choice(dates)) for _ in range(40)]
    observations = [(rng.choice([None, "o1", "o2"]), rng.choice([*ids, "z"])) for _ in range(120)]
    gold = build_observations_per_patient(*frames(patients, observations), as_of=AS_OF)
    expected = naive(patients, observations)
    assert gold.count() == len(expected)
    assert sorted(row.observation_count for row in gold.collect()) == sorted(expected.values())


@pytest.mark.parametrize(
    ("birth_date", "age"),
    [("2025-01-02", -1), ("2025-01-01", 0), ("2024-01-02", 1), ("2024-01-01", 1), ("1925-01-01", 100), ("2000-1-1", None), ("2000-02-30", None)],
)
def test_age_is_whole_365_day_years(spark, birth_date, age):
    gold = build_observations_per_patient(*frames([("p", birth_date)], []), as_of=AS_OF)
    assert gold.first().patient_age_years == age


def test_age_today_by_default(spark):
    born = (datetime.date.today() - datetime.timedelta(days=800)).isoformat()
    assert build_observations_per_patient(*frames([("p", born)], [])).first().patient_age_years == 2


def counted(spark, counts):
    return spark.createDataFrame([(f"p{i}", c) for i, c in enumerate(counts)], "patient_id string, observation_count bigint")


@pytest.mark.parametrize("seed", range(4))
def test_concentration_is_that_of_the_sorted_counts(spark, seed):
    rng = random.Random(seed)
    counts = [rng.choice([0, 1, 1, 2, 3, 50]) for _ in range(rng.choice([3, 10, 33, 104]))]
    fifth = len(counts) // 5
    ordered = sorted(counts, reverse=True)
    top, other = sum(ordered[:fifth]), sum(ordered[fifth:])
    assert tuple(concentration(counted(spark, counts)).first()) == (fifth, top, other, top > other)


def test_concentration_of_nothing(spark):
    assert tuple(concentration(counted(spark, [])).first()) == (0, 0, 0, False)


def test_ranking(spark):
    ranked = ranked_by_count(counted(spark, [1, 5, 3, 5]))
    assert [tuple(row) for row in ranked.collect()] == [("p1", 5), ("p3", 5), ("p2", 3), ("p0", 1)]


def test_hot_keys_are_counted_before_the_join(spark):
    """A third of the rows in one subject, and a third without an id, cross the shuffle as counts."""
    patients = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string"))).alias("id"),
        F.lit("2000-01-01").alias("birth_date"),
    )
    observations = spark.range(9000).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("subject_id")
    )
    gold = build_observations_per_patient(patients, observations, as_of=AS_OF)
    rows = {row.patient_id: row.observation_count for row in gold.collect()}
    assert len(rows) == 1002
    assert rows["hot"] == 1000 * 3000 and rows[None] == 0
