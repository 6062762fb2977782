"""Jobs: compositions of the operators into the published tables."""
