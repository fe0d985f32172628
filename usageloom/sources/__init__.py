"""Where events come from: tables, message streams, test data."""
