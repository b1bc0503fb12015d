"""Log metrics and stream sinks."""
