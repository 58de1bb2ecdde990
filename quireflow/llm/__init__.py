"""Operators of a training-data pipeline over a ``documents`` table.

Nothing outside this subpackage imports it.  Every module keeps a general
interface (a function from DataFrame to DataFrame with explicit parameters);
:mod:`quireflow.llm.queries` derives the registered queries from them.
"""
