"""DataFrame operators and batch jobs for civic-complaint tickets and rain gauges."""
