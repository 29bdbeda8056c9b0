"""Trip analytics on Spark: cleaning, features, zone demand, duration, anomalies and joint scoring."""
