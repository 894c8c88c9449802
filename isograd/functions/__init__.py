"""Column expressions: unit conversion, calendar keys, column naming."""
