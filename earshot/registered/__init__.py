"""The registered checks: each operator run over the given tables."""
