"""What to collect from each machine."""
