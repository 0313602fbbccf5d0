"""Reports and the pipeline built from the operators."""
