from __future__ import annotations

SF_DIR = "/root/testdata/sf0.001"

#: A documents table with columns named like internal ones.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, key string, _text string"


def frame(spark, rows):
    """Documents of (doc_id, text) rows, with NULL in all other columns."""
    return spark.createDataFrame([(d, t) + (None,) * 6 for d, t in rows], SCHEMA)
