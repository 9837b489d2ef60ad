"""Training-data operators over documents, pages and embeddings.

Nothing outside this package imports it; its queries are in ``kiln.llm.queries``.
"""
