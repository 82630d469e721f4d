"""Operators for preparing training data: licences, archives, languages, tokens, vectors, copies, mixtures."""
