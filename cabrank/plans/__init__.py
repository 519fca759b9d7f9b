"""Named trip questions and load pipelines."""
