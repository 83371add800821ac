"""Whole queries and jobs: reports, quality results, the batch run."""
