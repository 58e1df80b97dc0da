"""Operators for preparing large text corpora, their queries and their SQL.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when the subpackage is present.
"""
