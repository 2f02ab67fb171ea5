"""DataFrame-to-DataFrame steps of the stages."""
