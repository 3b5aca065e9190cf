"""DataFrame operators the checks are composed of."""
