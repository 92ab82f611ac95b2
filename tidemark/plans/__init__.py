"""The layer-to-layer loads, composed of sources, operators and sinks."""
