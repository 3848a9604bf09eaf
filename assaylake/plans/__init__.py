"""Jobs: operators joined to sources and sinks."""
