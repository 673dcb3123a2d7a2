"""The two jobs: copy what grew, and load what was copied."""
