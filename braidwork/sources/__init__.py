"""Sources and sinks: lookback scans, versioned state, checkpoints and catalogue metadata."""
