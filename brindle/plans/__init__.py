"""Ready-made plans: flight presets, tuning studies and the query catalog."""
