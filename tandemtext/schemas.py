"""Table layouts shared by sources, operators and the stream."""

from __future__ import annotations

ARTICLES = "doc_id BIGINT, text STRING"

# One entry of a chunk manifest, next to its chunk id.
MANIFEST_ENTRY = (
    "file_path STRING, sentence_count INT, is_translated BOOLEAN, created_at STRING, "
    "translated_at STRING, translated_file STRING"
)

PAIRS = "seq_id BIGINT, english STRING, source_text STRING, chunk_id BIGINT"

# What a translator's policy adds to a row.
TRANSLATION = "translated STRING, ok BOOLEAN, attempts INT, error STRING"
