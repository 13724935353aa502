"""Ready-made pipelines: compositions of the operators over register tables."""
