"""Table access, the business extracts and the snapshot store."""
