"""Daily wearable metrics and strength-training logs, analysed as Spark DataFrame jobs."""
