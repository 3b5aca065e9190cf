"""Column expressions: clocks and ages, labels, item and timestamp parsing."""
