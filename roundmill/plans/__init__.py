"""Query registry of the core and the matching SQL."""
