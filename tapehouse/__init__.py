"""tapehouse: market-data streams and tables as plain Spark DataFrame operators.

Layers: bronze (raw feed messages with typed envelopes), silver (cleaned,
de-duplicated, upserted keyed state), gold (bars, top of book) and serving
queries (resample, ladders, ticker, tape, sequence-gap reports).
"""

from tapehouse.operators.bronze import (  # noqa: F401
    parse_envelope,
    parse_orderbook,
    parse_trades,
    route_feed,
    route_label,
)
from tapehouse.operators.gold import ohlcv, top_of_book  # noqa: F401
from tapehouse.operators.quality import (  # noqa: F401
    message_counts,
    observe_feed,
    sequence_gaps,
    session_ids,
)
from tapehouse.operators.serve import (  # noqa: F401
    chart_bars,
    ladder,
    ladder_spread,
    last_bars,
    recent_trades,
    resample,
    ticker,
    ticker_24h,
    with_direction,
)
from tapehouse.operators.silver import (  # noqa: F401
    clean_trades,
    since_snapshot,
    flatten_levels,
    incremental_since,
    latest_levels,
    latest_per_key,
    silver_levels,
)
from tapehouse.operators.upsert import merge_into_table, upsert  # noqa: F401
from tapehouse.session import build_session  # noqa: F401
from tapehouse.sources.publish import publish_records  # noqa: F401

__version__ = "0.1.0"
