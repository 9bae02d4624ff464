"""DataFrame transforms the marts are composed of."""
