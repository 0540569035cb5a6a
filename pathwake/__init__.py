"""Behaviour-event analytics on PySpark: events, sessions, funnels and pipeline monitoring."""
