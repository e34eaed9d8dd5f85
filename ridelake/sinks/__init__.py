"""Writers for layers, dimensions and catalog entries."""
