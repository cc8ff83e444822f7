"""DataFrame -> DataFrame operators, meant to be chained with `df.transform`."""
