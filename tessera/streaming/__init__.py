"""New pool records as a stream."""
