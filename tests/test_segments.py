import pytest

from trailframe.operators import segments
from trailframe.operators.segments import threshold_micros


def ids(df):
    return [r["timedelta_id"] for r in df.orderBy("rental_id", "server_time", "device_time", "id").collect()]


# Gaps in seconds: flagged rows are the third, sixth and seventh.
GAPS = [0, 1, 100, 1, 1, 100, 100, 1]


def _rows(rental=1):
    total, rows = 0, []
    for g in GAPS:
        total += g
        rows.append((rental, total, 44.0, 12.0))
    return rows


def test_runs(track):
    assert ids(segments.timedelta(track(_rows()), 50)) == [1, 1, 2, 3, 3, 4, 4, 5]


def test_split(track):
    assert ids(segments.timedelta(track(_rows()), "50 s", mode="split")) == [1, 1, 2, 2, 2, 3, 4, 4]


def test_automatic_threshold(track):
    # mean 38, sample deviation about 51.4: 100 s gaps are flagged
    assert ids(segments.timedelta(track(_rows()))) == [1, 1, 2, 3, 3, 4, 4, 5]


def test_single_row_rental_is_one_segment(track):
    assert ids(segments.timedelta(track([(1, 0, 44, 12), (2, 5, 44, 12)]))) == [1, 1]


def test_hot_rental_equals_plain(track, hot):
    rows = _rows(1) * 1 + [(1, 1000 + 10 * i * i, 44, 12) for i in range(40)] + _rows(2)
    chunked = segments.timedelta(track(rows))
    chunked_ids = ids(chunked)
    chunked.sparkSession.conf.unset("trailframe.hot.minRows")
    assert chunked_ids == ids(segments.timedelta(track(rows)))


def test_time_gap_uses_whole_milliseconds(track):
    gaps = [r["time_gap"] for r in segments.time_gaps(track([(1, 0, 44, 12), (1, 1.2349, 44, 12)])).orderBy("id").collect()]
    assert gaps == [0.0, 1234.0]


def test_renumber(track):
    out = segments.renumber_segments(segments.timedelta(track(_rows(1) + _rows(2)), 50))
    assert ids(out) == [1, 1, 2, 3, 3, 4, 4, 5, 6, 6, 7, 8, 8, 9, 9, 10]


@pytest.mark.parametrize("text, micros", [("90", 90_000_000), ("2 minutes", 120_000_000), (1.5, 1_500_000), ("5ms", 5_000)])
def test_threshold_text(text, micros):
    assert threshold_micros(text) == micros


def test_bad_threshold():
    with pytest.raises(ValueError):
        threshold_micros("soon")
