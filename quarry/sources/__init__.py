"""Scans: shared parquet tables, text/JSON/XML corpora, WARC, tokenizer files."""
