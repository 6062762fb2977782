"""Code tables of the public sources: plain mappings from code to label."""
