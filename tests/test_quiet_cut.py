from datetime import date, datetime, timedelta

import pytest

from conftest import GRID
from hourgrid.operators import split
from hourgrid.spec import DemandSpec

SPEC = DemandSpec(step="day")
FIRST, LAST = date(2023, 10, 1), date(2024, 2, 10)
HOLIDAYS = {date(2023, 12, 24): 0.6, date(2023, 12, 25): 0.4, date(2023, 12, 31): 0.6, date(2024, 1, 1): 0.5}


@pytest.fixture
def table(spark):
    """Two stations with a week's pattern, a slow trend, and totals that drop on some days."""

    def make(drops, missing=()):
        rows = []
        for i in range((LAST - FIRST).days + 1):
            day = FIRST + timedelta(days=i)
            usual = (2000 if day.weekday() >= 5 else 3300) + 2 * i + (i * 7) % 23
            for sid in "12":
                if (day, sid) not in missing:
                    when = datetime(day.year, day.month, day.day)
                    rows.append((sid, f"n{sid}", "b", "m", when, int(usual * drops.get(day, 1)), 0))
        return spark.createDataFrame(rows, GRID)

    return make


def cut_of(df, cut, **how):
    return split.quiet_cut(df, cut, SPEC, **how).first()["train_end"]


def test_only_the_holidays_are_unusual(table):
    scores = split.day_scores(table(HOLIDAYS), SPEC)
    assert {r.date for r in scores.where("unusual").collect()} == set(HOLIDAYS)
    assert scores.count() == (LAST - FIRST).days + 1


def test_a_cut_after_christmas_moves_past_new_year(table):
    assert cut_of(table(HOLIDAYS), "2023-12-26 13:00:00") == datetime(2024, 1, 2)


def test_a_cut_in_ordinary_days_stays_or_moves_to_midnight(table):
    df = table(HOLIDAYS)
    assert cut_of(df, "2023-11-14 00:00:00") == datetime(2023, 11, 14)
    assert cut_of(df, "2023-11-14 13:00:00") == datetime(2023, 11, 15)
    assert cut_of(df, "2023-12-27 00:00:00", ahead=2) == datetime(2023, 12, 27)


def test_without_a_quiet_day_the_cut_stays(table):
    df = table({LAST: 0.3, LAST - timedelta(days=3): 0.3})
    assert cut_of(df, "2024-02-08 06:00:00") == datetime(2024, 2, 8, 6)
    assert cut_of(df.limit(0), "2024-02-08 06:00:00") == datetime(2024, 2, 8, 6)


def test_days_that_are_not_whole_are_not_judged(table):
    df = table({}, missing={(LAST, "2")})
    assert not split.day_scores(df, SPEC).where("unusual").count()
    assert split.day_scores(df, SPEC).where(f"date = '{LAST}'").count() == 0


def test_cuts_of_the_spec(table):
    df = table(HOLIDAYS)
    # 65 % of the range end on 26 December.
    plain = split.spec_with_cuts(df, (0.65, 0.15), SPEC)
    moved = split.spec_with_quiet_cuts(df, (0.65, 0.15), SPEC)
    assert plain.train_end == "2023-12-26 00:00:00"
    assert moved.train_end == "2024-01-02 00:00:00"
    assert moved.validation_end > plain.validation_end
    quiet = table({})
    assert split.spec_with_quiet_cuts(quiet, (0.65, 0.15), SPEC) == split.spec_with_cuts(quiet, (0.65, 0.15), SPEC)
