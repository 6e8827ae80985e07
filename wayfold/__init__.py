"""Activity- and travel-diary analytics as DataFrame operations."""
