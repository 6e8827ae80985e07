"""Tables: reading, writing and schemas."""
