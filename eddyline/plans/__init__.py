"""Registered queries (Spark plans over the driver's tables) and their SQL oracles."""
