"""Column expressions: calendar, hydrology, numbers and names. All stay inside whole-stage code generation."""
