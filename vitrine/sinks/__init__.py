"""Table, file and versioned writers."""
