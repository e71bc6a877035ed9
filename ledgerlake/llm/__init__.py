"""Operators of a training-data pipeline: extraction, language, privacy, duplicates, tokens, chat, mixing.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``kernels`` holds the numpy routines that several of them share and
``queries`` the registered queries with their SQL.
"""
