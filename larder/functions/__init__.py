"""Column builders: expressions only, no DataFrame is touched here."""
