"""Feature sets, training sets, models and whole forecasts."""
