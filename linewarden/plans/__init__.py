"""Reports, dashboard datasets and end-to-end jobs built from the operators."""
