"""Data checks. Each returns the violating rows as a DataFrame; none means the check passed."""
