"""Readers and writers: CSV, topic, lake, raw table, score table, star export and models."""
