import datetime as dt
import json
from pathlib import Path

import pytest

from tests.conftest import rows
from tidemark.functions import fixed
from tidemark.operators import profile, quality

ODS = "event_id string, event_type string, created_at string, dt date, hour int"


def day(n):
    return dt.date(2024, 1, n)


def daily(spark, *counts):
    """One row per event, ``counts`` events on day 1, 2, ... (0: day absent)."""
    return spark.createDataFrame(
        [(f"{i}-{j}", "PushEvent", "t", day(i + 1), j % 24) for i, n in enumerate(counts) for j in range(n)], ODS)


def test_blank_values(spark):
    df = spark.createDataFrame([("1", "A", "t", day(1), 0), ("", None, "t", day(1), 0), (None, "", "", day(1), 0)], ODS)
    got = quality.null_audit(df, "event_id", "event_type", "created_at").first()
    assert tuple(got) == (3, 2, 2, 1)
    assert tuple(quality.null_audit(df.limit(0), "event_id").first()) == (0, 0)


def test_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string")
    assert tuple(quality.duplicate_rate(df, "event_id").first()) == (3, 2, 1, 1 / 3, False)
    assert tuple(quality.duplicate_rate(df.limit(0), "event_id").first()) == (0, 0, 0, 0.0, True)


def test_hours(spark):
    full, short, poor = daily(spark, 24, 30), daily(spark, 24, 23), daily(spark, 24, 24, 22)
    assert tuple(quality.hour_completeness(full).first()) == (2, 24, 0, "", True)
    assert tuple(quality.hour_completeness(short).first()) == (2, 23, 1, "2024-01-02 (23h)", True)
    assert tuple(quality.hour_completeness(poor).first()) == (3, 22, 1, "2024-01-03 (22h)", False)
    assert tuple(quality.hour_completeness(full.limit(0)).first()) == (0, 0, 0, "", False)


def test_hours_list_all_short_days(spark):
    got = quality.hour_completeness(daily(spark, *[3] * 9)).first()
    assert got.short_days == 9 and got.short_list.count("(3h)") == 9 and got.short_list.startswith("2024-01-01")


def test_volatility_over_days_present(spark):
    got = quality.volatility(daily(spark, 10, 0, 15, 15, 3)).first()  # 0.5, 0.0, 0.8
    assert (got.days, got.worst_change, got.worst_from, got.worst_to, got.median_change, got.passed) == (
        4, 0.8, day(4), day(5), 0.5, True)


def test_upper_median_of_an_even_number(spark):
    got = quality.volatility(daily(spark, 10, 11, 11, 22, 22)).first()  # 0.1, 0, 1.0, 0
    assert (got.median_change, got.worst_change, got.passed) == (0.1, 1.0, False)


@pytest.mark.parametrize("counts", [(), (5,)])
def test_volatility_needs_two_days(spark, counts):
    df = daily(spark, *counts) if counts else daily(spark, 1).limit(0)
    assert tuple(quality.volatility(df).first()) == (len(counts), 0.0, None, None, 0.0, True)


def test_steepest_pair_is_the_first_of_equals(spark):
    got = quality.volatility(daily(spark, 4, 2, 1)).first()
    assert (got.worst_from, got.worst_to) == (day(1), day(2))


def test_calibration(spark):
    got = quality.volatility_calibration(daily(spark, 10, 11, 22)).first()  # 0.1, 1.0
    assert (got.changes, got.min_change, got.median_change, got.max_change) == (2, 0.1, 1.0, 1.0)
    assert got.suggested_limit == pytest.approx(0.55 + 2 * 0.6363961, abs=1e-6)


def test_unknown_values_ignore_null(spark):
    df = spark.createDataFrame([("PushEvent",), ("Odd",), (None,)], "event_type string")
    assert tuple(quality.unknown_values(df, "event_type", fixed.EVENT_TYPES).first()) == (1, False)


def test_rules_and_gate(spark):
    good, fact = daily(spark, 24, 24), daily(spark, 24, 24)
    rules = quality.quality_rules(good, fact)
    assert [r.id for r in rules.orderBy("id").collect()] == ["R1", "R2", "R3", "R4", "R5"]
    assert tuple(quality.quality_summary(rules).first()) == ("all", 5, 5, 0, 0, True)
    blank = good.union(spark.createDataFrame([("", "PushEvent", "t", day(1), 0)], ODS))
    assert tuple(quality.quality_summary(quality.quality_rules(blank, fact)).first()) == ("all", 5, 4, 1, 1, False)


def test_one_day_only(spark):
    ods = daily(spark, 24, 5)
    by_day = {d: {r.id: r.passed for r in quality.quality_rules(ods, ods, d).collect()} for d in ("2024-01-01", day(2))}
    assert by_day["2024-01-01"]["R3"] is True and by_day[day(2)]["R3"] is False
    assert by_day[day(2)]["R4"] is True


def test_document(spark, tmp_path):
    rules = quality.quality_rules(daily(spark, 24), daily(spark, 24))
    quality.quality_document(rules, "2024-01-01").coalesce(1).write.json(str(tmp_path / "report"))
    (file,) = Path(tmp_path / "report").glob("*.json")
    doc = json.loads(file.read_text())
    assert doc["scope"] == "2024-01-01" and doc["summary"]["total"] == 5
    assert [r["id"] for r in doc["rules"]] == ["R1", "R2", "R3", "R4", "R5"]


def test_missing_hours(spark):
    df = spark.createDataFrame([("1", "A", "t", day(1), h) for h in range(24) if h != 20]
                               + [("2", "A", "t", day(3), h) for h in range(24)], ODS)
    got = rows(quality.missing_hours(df))
    assert got == sorted([(day(1), 20)] + [(day(2), h) for h in range(24)], key=repr)
    wanted = quality.expected_hours(spark, day(4), "2024-01-04")
    assert rows(quality.missing_hours(df, wanted)) == sorted([(day(4), h) for h in range(24)], key=repr)
    assert quality.missing_hours(df.limit(0)).count() == 0


def test_hour_coverage_leaves_one_hour_per_day(spark):
    assert profile.ods_hour_coverage(daily(spark, 23, 23)).first().passed is True
    assert profile.ods_hour_coverage(daily(spark, 23, 22)).first().passed is False


def test_type_share(spark):
    df = spark.createDataFrame([("A",)] * 5 + [("B",)] * 2 + [(None,)], "event_type string")
    assert [tuple(r) for r in profile.ods_type_share(df, 2).collect()] == [("A", 5, 62.5), ("B", 2, 25.0)]
