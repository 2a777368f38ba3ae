"""Training-data operators: deduplication, filtering, formatting, tokenisation and search.

Nothing outside this subpackage imports it; :mod:`cellquant.llm.queries` lists its queries.
"""
