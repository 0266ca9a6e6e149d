"""Training-data operators: ten distributed operators over documents, pages, embeddings and conversations.

Nothing else in the library imports this subpackage. ``catalog`` registers one query per operator.
"""
