"""The count by hour on a stream of events."""
