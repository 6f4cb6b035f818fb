"""Wide rows, cells and overwriting tables."""
