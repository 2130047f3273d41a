from millrace.streaming.ingest import landing_stream, stream_ingest
from millrace.streaming.windows import BY_BATCH, BY_DAY, stream_by_lateness, stream_windows

__all__ = ["BY_BATCH", "BY_DAY", "landing_stream", "stream_by_lateness", "stream_ingest", "stream_windows"]
