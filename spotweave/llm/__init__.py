"""Operations of a training-data pipeline over document, page and URL tables.

Nothing else in the package imports this subpackage.  Every operator takes and returns DataFrames;
the thin ``opN_*`` queries that digest their results live in :mod:`spotweave.llm.queries`.
"""
