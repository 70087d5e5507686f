"""Operators for training-data pipelines over ``documents``, ``pages`` and ``embeddings``. Nothing else imports this package."""
