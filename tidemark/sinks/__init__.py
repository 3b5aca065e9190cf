"""Sinks: table contracts, append-only history, keyed current state."""
