"""Table catalog, readers, writers and the fixture views over the driver tables."""
