"""Operators of a training-data pipeline; see ``harrow.llm.queries`` for their queries."""
