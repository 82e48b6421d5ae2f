"""Readers and writers: line files, named corpora, rule files, cleaned corpora."""
