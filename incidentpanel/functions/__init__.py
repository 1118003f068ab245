"""Column expressions: cleaning, labels, calendar arithmetic, geometry."""
