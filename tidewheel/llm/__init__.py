"""Training-data operators: thirteen operators on documents, conversations and embeddings.

Nothing outside this subpackage imports it. Queries and their SQL are in ``queries``.
"""
