"""Record sources, the generator and the snapshot store."""
