"""Properties of cleaning that hold for any rows."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings, strategies as st

from vidlake.operators.cleaning import clean_videos
from vidlake.operators.mapping import silver_rows
from vidlake.operators.quality import failed_rules, quality_report
from vidlake.operators.rollups import channel_rollup, daily_rollup
from vidlake.schemas import CANONICAL

number = st.one_of(st.integers(-50, 50).map(str), st.sampled_from(["n/a", "12.7", "", None]))
row = st.fixed_dictionaries(
    {
        "video_id": st.sampled_from(["a", " a", "b ", None]),
        "extraction_date": st.sampled_from(["2024-02-01", "2024-02-02", None]),
        "title": st.sampled_from(["x", " ", None]),
        "channel_title": st.sampled_from(["c", " c ", "d"]),
        "published_date": st.sampled_from(["2024-01-05", "2024-01-06T10:00:00Z", "junk", None]),
        "views": number,
        "likes": number,
        "comments": number,
        "description": st.sampled_from([None, "d"]),
    }
)
# Small: every example is a handful of Spark jobs.
few = settings(
    max_examples=8,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


@few
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_clean_videos(videos, rows):
    frame = videos(*rows)
    cleaned = clean_videos(silver_rows(bronze=frame))
    got = sorted(cleaned.collect(), key=repr)
    assert len({(r.video_id, r.extraction_date) for r in got}) == len(got)
    assert all(0 <= r.likes <= r.views and 0 <= r.comments <= r.views for r in got)
    # Neither the order nor the partitioning of the rows matters.
    other = clean_videos(silver_rows(bronze=videos(*rows[::-1]).repartition(5)))
    assert sorted(other.collect(), key=repr) == got
    # Cleaning what is clean changes nothing.
    assert sorted(clean_videos(cleaned.select(*CANONICAL)).collect(), key=repr) == got
    failed = {r.rule for r in failed_rules(quality_report(cleaned)).collect()}
    assert failed == (set() if got else {"empty_table"})
    channels, days = channel_rollup(cleaned).collect(), daily_rollup(cleaned).collect()
    for name in ("total_videos", "total_views"):
        assert sum(r[name] for r in channels) == sum(r[name] for r in days)
    assert sum(r.total_videos for r in days) == len(got)
