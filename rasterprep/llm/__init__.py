"""Operators for preparing text corpora: fingerprints, token files, language and
quality scores, exact and near duplicates, packing and byte-level BPE.

Each module holds one operator with a general interface; ``queries`` holds the
thin registered queries and their DuckDB SQL.  Nothing outside this subpackage
(and ``corpus_pipeline.py``) imports it.
"""
