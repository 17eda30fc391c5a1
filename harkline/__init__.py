"""Play histories, track features and genre labels, analysed on Spark."""
