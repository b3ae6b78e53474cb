"""DataFrame operators: evaluation, quality, telemetry, ground truth, graphs, listings and model output."""
