"""Training-data operators: text, token and vector jobs over whole corpora.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
