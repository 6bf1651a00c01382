"""Operations of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage. Each operator takes
DataFrames with the caller's column names and returns DataFrames; the thin
registered queries in :mod:`landfall.llm.queries` apply them to the driver's
tables and derive the digest columns.
"""
