"""Representative-panel analytics as PySpark DataFrame operators."""
