"""Readers and writers: sensor files, forecast files, registry tables, stored tables."""
