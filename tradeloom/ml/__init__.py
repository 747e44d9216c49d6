"""Model features, splits, models, metrics, forecasts and the combined risk score."""
