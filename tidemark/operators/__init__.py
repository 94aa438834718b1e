"""DataFrame operators over change logs and events."""
