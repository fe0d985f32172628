"""Product-analytics operators: each takes the event log (or a rollup of it) and returns a DataFrame."""
