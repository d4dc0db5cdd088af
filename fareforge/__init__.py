"""fareforge: ride-fare analytics, temporal features and time-ordered model evaluation on Spark."""
