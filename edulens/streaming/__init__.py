"""Streaming: incremental ingestion of run-log records.

The analyses have no streaming semantics of their own (no windows, no late
data); what arrives continuously is run-log results. They are appended
with Structured Streaming (see :mod:`edulens.streaming.runlog_ingest`).
"""
