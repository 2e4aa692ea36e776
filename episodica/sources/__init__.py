"""Sources and sinks: steps, metadata, videos, the training store, reports."""
