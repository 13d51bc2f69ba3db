import pytest


@pytest.fixture(scope="session")
def events_schema():
    return "video_id string, event_id string, start_ms bigint, end_ms bigint, speaker string, text string, source_file string, review_required boolean, work_id string, chunk int, n int"


@pytest.fixture(scope="session")
def make_events(spark, events_schema):
    """Rows of (video, number, start, end, speaker, text) as an event table with columns of clashing names."""

    def make(rows, source="deck_a/x.mp4"):
        full = [(v, None if k is None else f"event_{k:06d}", s, e, who, text, source, False, "clash", 1, 2) for v, k, s, e, who, text in rows]
        return spark.createDataFrame(full, events_schema)

    return make
