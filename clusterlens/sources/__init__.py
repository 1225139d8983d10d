"""Readers and writers: delimited records, JSON reports, record streams."""
