"""Column functions: text cleaning, timestamps, durations and keys."""
