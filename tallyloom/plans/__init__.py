"""Jobs made of sources, operators and sinks."""
