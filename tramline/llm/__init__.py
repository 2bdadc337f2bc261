"""Operators for preparing training text, each a DataFrame function; nothing else imports them."""
