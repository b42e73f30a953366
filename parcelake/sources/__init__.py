"""Where rows come from and go to: message log, raw files, tables, serving store."""
