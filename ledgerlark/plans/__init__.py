"""Composed plans: wide table, star schema, summary marts and the whole pipeline."""
