"""Where rows go: topics, stored tables, keyed stores, dated indexes."""
