"""Training-data operators: filtering, de-duplication, mixing, packing, formatting and scoring.

Each operator is a function from DataFrames to a DataFrame.  The thin ``op*`` queries that the
driver calls live in :mod:`marketlake.llm.queries`.  Nothing outside this subpackage imports it.
"""
