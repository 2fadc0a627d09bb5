"""Structured Streaming jobs: quarantine split and versioned history."""
