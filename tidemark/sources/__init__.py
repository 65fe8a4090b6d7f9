"""Configuration, metadata, the snapshot store and sinks."""
