from lodestar.streaming.ingest import land_stream, stream_state, upsert_stream

__all__ = ["land_stream", "stream_state", "upsert_stream"]
