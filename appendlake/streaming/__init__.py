"""The load job as a stream."""
