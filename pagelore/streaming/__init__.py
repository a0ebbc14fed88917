"""The map-only jobs over files that keep arriving."""
