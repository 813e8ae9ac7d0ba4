"""Training-data operators: quality, language, tokens, near and substring
duplicates, page text, contamination, neighbours and line boilerplate.

Nothing else in the library imports this subpackage.
"""
