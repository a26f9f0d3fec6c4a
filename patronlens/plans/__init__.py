"""Reports, period runs, and the registry of checkable queries."""
