"""The named queries, their SQL checks, and the end-to-end workflow."""
