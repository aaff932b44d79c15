"""DataFrame operators: dimensions, days, workouts, weeks, trends and the metric feed."""
