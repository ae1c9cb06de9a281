"""DataFrame-to-DataFrame operators, shared by batch and streaming jobs."""
