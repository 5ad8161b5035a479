"""Operators of a training-data pipeline over `documents`, `pages`, `benchmark`
and `labels`.  One module per operator; `queries.py` registers them.  Nothing
else in the library imports this subpackage."""
