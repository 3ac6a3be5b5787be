"""The streaming query runs to its end, however long it takes."""

from __future__ import annotations

from pyspark.sql.streaming.query import StreamingQuery

from barloom import queries


def test_stream_bars_wait_without_a_limit(spark, data, monkeypatch):
    waited, wait = [], StreamingQuery.awaitTermination
    monkeypatch.setattr(StreamingQuery, "awaitTermination", lambda self, timeout=None: (waited.append(timeout), wait(self))[1])
    assert queries.stream_bars(spark, data).count() > 0 and waited == [None]
