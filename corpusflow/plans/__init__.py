"""Query bindings to the driver tables and their SQL oracles."""
