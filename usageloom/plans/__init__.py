"""Named queries over a data folder, their DuckDB twins, and the KPI suite."""
