"""Structured Streaming forms of the daily counts and of the ledger."""
