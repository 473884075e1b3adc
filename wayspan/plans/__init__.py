"""Whole jobs: daily ingest, published payloads, queries of users, command line."""
