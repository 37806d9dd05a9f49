"""What a user runs: cleaned tables, marts and reports, each one lazy plan."""
