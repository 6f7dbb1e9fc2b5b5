"""Stream == batch: every streaming form replays the whole table through a
file stream and must give exactly the rows of the batch oracle."""

import os

import pytest

import __spark_entry__ as E
from test_entry import check, duck  # noqa: F401  (fixture)


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.endswith("_stream")))
def test_stream_matches_batch_oracle(spark, duck, name):  # noqa: F811
    check(spark, duck, name)


BOUNDARY_SENSITIVE = ["q1_login_fail_check_stream", "q5_order_pay_timeout_stream", "q7_temp_rising_stream",
                      "j2_order_outcome_stream", "a3_rolling_min_by_stream", "q3_login_fail_cep_stream",
                      "w5_count_window_sliding_stream", "b1_capped_clicks_stream", "j1_tx_reconcile_stream"]


# 7 micro-batches by default; EVENTIDE_SLOW_TESTS=1 adds the single-batch replay
CHUNKS = [1, 7] if os.environ.get("EVENTIDE_SLOW_TESTS") == "1" else [7]


@pytest.mark.parametrize("chunks", CHUNKS)
@pytest.mark.parametrize("name", BOUNDARY_SENSITIVE)
def test_stateful_streams_ignore_batch_boundaries(spark, duck, name, chunks, monkeypatch):  # noqa: F811
    from eventide.plans import streams

    monkeypatch.setattr(streams, "REPLAY_CHUNKS", chunks)
    check(spark, duck, name)
