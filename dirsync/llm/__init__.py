"""Operators for preparing text corpora at scale; nothing else imports them."""
