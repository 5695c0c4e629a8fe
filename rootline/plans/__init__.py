"""Composed plans: the full run over events, the registered queries and their oracle SQL."""
