"""Where rows come from and where results are stored."""
