"""Spark pipeline for board-game records: PGN text, JSON messages, keyed game tables."""
