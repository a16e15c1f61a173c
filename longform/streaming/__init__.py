"""Incremental loads: batch ledger and Structured Streaming."""
