"""The message stream and its way into bronze."""

from strataflow.streaming.ingest import route_messages, start_bronze_stream

__all__ = ["route_messages", "start_bronze_stream"]
