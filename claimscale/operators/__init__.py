"""Relational steps: joins, rankings, aggregates, matrices, the topic model."""
