"""Operators for building training corpora: see ``millrace.llm.queries`` for the registered forms."""
