from txnlab.streaming.scoring import (  # noqa: F401
    hourly_alert_counts,
    read_transaction_stream,
    score_stream,
    start_alert_sink,
)
