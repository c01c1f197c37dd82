"""Windowed aggregates, ordered counts, ranks, labels, lookups and calendars."""
