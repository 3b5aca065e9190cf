"""The registered queries: stand-in inputs, Spark queries and oracle SQL."""
