import pytest

from hostscope.operators.registry import OperatorSpec, apply
from hostscope.sources.sessions import PORT_SETS, sessions


def test_a_job_as_data(spark, sf):
    steps = [OperatorSpec("clean"), OperatorSpec("role_views"), OperatorSpec("stamp_slice", {"minutes": 1440}), OperatorSpec("slice_metrics", {"sets": PORT_SETS})]
    out = apply(sessions(spark, sf), steps)
    assert {"sessions_cnt", "db_port_sessions_cnt", "max_sessions_per_minute", "bytes_sent_p99"} <= set(out.columns)
    with pytest.raises(ValueError, match="nope"):
        apply(out, [OperatorSpec("nope")])
