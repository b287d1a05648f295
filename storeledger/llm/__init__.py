"""Training-data operators: tokenising, scoring, de-duplicating and redacting documents.

Every operator takes and returns DataFrames. A document is a row with ``doc_id``
and ``text``; a null text counts as empty, other columns are left alone.
Nothing else in the library imports this subpackage.
"""
