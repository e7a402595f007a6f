"""Corpus operators for training-data pipelines; nothing else imports this."""
