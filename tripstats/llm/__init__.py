"""Operations of a training-data pipeline over ``documents`` and ``pages``.

Ten operators, one module each; their thin registered queries are in
:mod:`tripstats.llm.queries`.  Nothing else in the library imports this
subpackage.
"""
