"""Where rows come from: files, column names and versioned tables."""
