"""Sources and sinks: schema'd scans, sample scans, feature/submission sinks, models."""
