"""New raw months as a stream."""
