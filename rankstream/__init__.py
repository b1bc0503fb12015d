"""PySpark-native analytics over ranked match data and game-server request logs."""

__version__ = "0.1.0"
