"""Training-data pipeline operators.

Nothing outside this subpackage, ``tests/llm`` and ``corpus_pipeline.py``
imports it.  Each module holds one operator with its own general interface;
``queries`` binds them to the ``documents`` table.
"""
