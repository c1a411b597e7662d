"""Column functions: predicates, scalar functions, telemetry fields."""
