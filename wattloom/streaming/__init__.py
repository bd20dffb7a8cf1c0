"""The same loads as Structured Streaming jobs on file sources."""
