"""Structured Streaming triage."""
