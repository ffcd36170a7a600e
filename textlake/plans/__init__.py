"""Jobs, and the named queries over the driver tables with their SQL twins."""
