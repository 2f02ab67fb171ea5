"""The stages: diagnose, aggregate, synthesize, run."""
