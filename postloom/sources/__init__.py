"""Where rows come from: topics, stored tables, search results."""
