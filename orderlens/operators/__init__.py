"""Order-analytics operators: every one takes and returns a DataFrame."""
