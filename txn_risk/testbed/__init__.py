"""Test tables as card transactions, the query catalogue over them and its oracle SQL."""
