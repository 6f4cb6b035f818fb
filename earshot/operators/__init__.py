"""Split, fit, score, evaluate, top-k and upsert."""
