"""Reading source files, the warehouse tables, and the driver's test tables."""
