"""Composed plans: marts, the end-to-end pipeline and the query registry."""
