"""Composed plans: reports and the end-to-end triage."""
