"""Writers: the table store, publishing and stream sinks."""
