"""Binds the operators to the benchmark tables: domain views, queries, oracle SQL."""
